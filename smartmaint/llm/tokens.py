"""Token ids of whole texts, with word caches, for Python workers.

Texts are split at ASCII white space; the tokenizer's own rules (white space
collapses, words never join across it) make the ids of a text the
concatenation of the ids of these chunks. Chunks repeat, so their ids are
kept in bounded two-generation caches that live as long as the worker.

Chunks made of code points below U+0250 other than a few excluded ones go
through a merge loop over the tokenizer file's own vocabulary
(``tiktoken``'s core on the same merge order; each word ends in a byte that
UTF-8 never holds, which stands for the vocabulary's end-of-word mark). Any
other chunk is encoded by the ``tokenizers`` library itself. The tests
compare both on a large set of words.

With ``special`` the strings of the file's added tokens (``<|endoftext|>``)
give their one id, as the library's default does: a chunk that holds one goes
to the library. Without, they are ordinary text.
"""

from __future__ import annotations

import os
import struct
import threading

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END_OF_WORD = "</w>"


class Generations(dict):
    """A cache with at most ``2 * limit`` entries: on overflow the older half goes."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_of_char() -> dict[str, int]:
    """The usual byte alphabet of byte-level vocabularies: printable Latin-1 stays, the rest moves up."""
    stay = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in stay]
    return {chr(b): b for b in stay} | {chr(256 + i): b for i, b in enumerate(moved)}


class WordTokenizer:
    """Ids of texts under a word-end BPE file, as packed little-endian uint32."""

    def __init__(self, path: str, limit: int = 300_000, special: bool = False):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.exact = Tokenizer.from_file(path)
        added = [t["content"] for t in spec["added_tokens"]] if special else []
        if any(t.split() != [t] for t in added):
            raise ValueError("added tokens with white space: chunks would cut them")
        # a file may match them in normalised text, so their case does not matter here
        # each begins with one of few characters, which is looked for first
        self.first = "".join(sorted({c for t in added for c in (t[0].lower(), t[0].upper())}))
        found = regex.compile("|".join(map(regex.escape, added)), regex.IGNORECASE).search if added else None
        self.added = (lambda w: any(c in w for c in self.first) and found(w)) if added else lambda _: None
        self.exact.encode_special_tokens = not special
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        # no-break space and NEL count as white space, U+0130 lower-cases to two characters
        self.simple = regex.compile("[!-~¡-įı-ɏ]*").fullmatch
        byte = _byte_of_char()
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            end = token.endswith(END_OF_WORD) and i >= 256
            core = token[:-len(END_OF_WORD)] if end else token
            ranks[bytes(byte[c] for c in core) + (b"\xff" if end else b"")] = i
        self.core = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks,
                                      special_tokens={})._core_bpe.encode_single_piece
        self.pieces = Generations(self._piece, limit)
        self.chunks = Generations(self._chunk, limit)

    def _piece(self, piece: str) -> bytes:
        ids = self.core(piece.encode() + b"\xff")
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: bytes) -> bytes:
        word = chunk.decode()
        if self.simple(word) and not self.added(word):
            pieces = self.split(word.lower())
            # a chunk of one piece is kept once, under the chunk
            return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self.pieces.__getitem__, pieces))
        ids = self.exact.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str | None) -> bytes:
        """Packed ids of the whole text (null: empty); no special tokens are put around it."""
        return b"".join(map(self.chunks.__getitem__, text.encode().split())) if text else b""


IDLE_SECONDS = 2.0

_LOADED: dict[tuple[str, bool], WordTokenizer] = {}
_RESTING: list[threading.Timer] = []


def word_tokenizer(path: str, special: bool = False) -> WordTokenizer:
    """One tokenizer for each file, mode and worker process."""
    while _RESTING:
        _RESTING.pop().cancel()
    if (path, special) not in _LOADED:
        _LOADED[path, special] = WordTokenizer(path, special=special)
    return _LOADED[path, special]


def forget() -> None:
    """Empty the word caches; they fill again as needed."""
    for t in _LOADED.values():
        for cache in (t.pieces, t.chunks):
            cache.clear()
            cache.old = {}


def rest() -> None:
    """A task is done: if none follows in this worker within ``IDLE_SECONDS``, its word caches go.

    Spark keeps idle workers, and other stages need the memory. A task that
    begins while the caches go only fills them again; ids do not change.
    """
    from smartmaint.llm.common import release
    timer = threading.Timer(IDLE_SECONDS, release)
    timer.daemon = True
    timer.start()
    _RESTING.append(timer)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
