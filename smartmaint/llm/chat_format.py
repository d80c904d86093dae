"""Operator 5, chat formatting into budgeted windows.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside
texts get a backslash after their first character (one more, if some are
there), which reading back takes out again.

A conversation is cut into windows of at most ``budget`` tokens, at turns:
prefix sums of the turns' tokens say where a window must end. A later window
starts with the conversation's system turn and with as many of the turns
before it as ``history`` tokens hold; these repeats are masked, so that each
assistant text is a target once. Repeated turns give way to the next turn, the
oldest first; the system turn stays. Turns are not cut: a turn that exceeds
the budget, alone or with the system turn, has a window without other turns;
no other window exceeds it.

Long conversations: turns are numbered by a range sort (a partition's running
numbers plus the counts of the partitions before it, which matter only for
the conversations that span partitions), and every ``segment`` turns a new
window starts. So a task holds one segment at a time, and a conversation with
a third of all turns is formatted by many.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from smartmaint.llm.common import materialize, table
from smartmaint.llm.line_dedup import small

BUDGET = 1024
HISTORY = 256
SEGMENT = 4096

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates.
CONTROL = [START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>"]

WINDOW_SCHEMA = ("conv_id long, segment long, window long, formatted string, "
                 "loss array<struct<start:int,end:int>>, repeated int, tokens int")


_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[])(\\*)({_REST})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_REST})")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _role_out(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _role_in(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted window."""
    out = []
    for part in formatted.split(END + "\n")[:-1]:
        role, _, text = part[len(START):].partition("\n")
        out.append((_role_in(role), unescape(text)))
    return out


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running numbers of each conversation's turns within a sorted partition."""
    from pyspark import TaskContext
    pid, conv, no = TaskContext.get().partitionId(), (), 0
    for b in batches:
        numbers = []
        for c in b.column(0).to_pylist():
            no = no + 1 if (c,) == conv else 0
            conv = (c,)
            numbers.append(no)
        yield pa.RecordBatch.from_arrays(
            [*(b.column(i) for i in range(3)), pa.array(numbers, pa.int64()), pa.array([pid] * b.num_rows, pa.int64())],
            names=["conv_id", "role", "text", "local", "pid"])


class _Segment:
    """The turns of one segment: its own, the system turn and the turns before it."""

    def __init__(self, key: tuple, size: int):
        self.key, self.size, self.system, self.turns, self.own = key, size, None, [], []

    def add(self, no: int, role: str, text: str, tokenizer) -> None:
        head = START + _role_out(role) + "\n"
        body = escape(text)
        turn = (head, body, END + "\n", len(tokenizer.ids(head + body + END)) // 4, role == "assistant")
        if no == 0 and role == "system":
            self.system = turn
        self.own.append(no // self.size == self.key[1])
        self.turns.append((no, turn))

    def windows(self, budget: int, history: int) -> Iterator[tuple]:
        import numpy as np
        upto = np.concatenate(([0], np.cumsum([t[3] for _, t in self.turns])))  # prefix sums
        i = next((k for k, own in enumerate(self.own) if own), len(self.turns))
        window = 0
        while i < len(self.turns):
            before = []
            if self.turns[i][0] > 0:
                lowest = 1 if self.system and self.turns[0][0] == 0 else 0  # the system turn is repeated by itself
                system = [self.system] if self.system else []
                left = min(history, budget - self.turns[i][1][3] - sum(t[3] for t in system))
                first = max(lowest, int(np.searchsorted(upto, upto[i] - left, "left"))) if left > 0 else i
                before = system + [t for _, t in self.turns[first:i]]
            used = sum(t[3] for t in before)
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + budget - used, "right")) - 1)
            parts, loss, at = [], [], 0
            for k, (head, body, tail, _, target) in enumerate([*before, *(t for _, t in self.turns[i:j])]):
                if target and k >= len(before) and body:
                    loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
                parts += [head, body, tail]
                at += len(head) + len(body) + len(tail)
            yield (*self.key, window, "".join(parts), loss, len(before), used + int(upto[j] - upto[i]))
            i, window = j, window + 1


def _format(batches: Iterator[pa.RecordBatch], path: str, budget: int, history: int, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    from smartmaint.llm.tokens import word_tokenizer
    tok = word_tokenizer(path)
    segment, out = None, []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)

    for b in batches:
        for conv, seg, no, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if segment is None or segment.key != (conv, seg):
                if segment is not None:
                    out.extend(segment.windows(budget, history))
                segment = _Segment((conv, seg), size)
                if len(out) >= 1000:
                    yield flush()
            segment.add(no, role, text, tok)
    if segment is not None:
        out.extend(segment.windows(budget, history))
    yield flush()


def format_conversations(turns: DataFrame, tokenizer_path: str, budget: int = BUDGET, history: int = HISTORY,
                         segment: int = SEGMENT) -> DataFrame:
    """Windows of all conversations (columns conv_id, turn, role, text).

    ``conv_id, segment, window`` order a conversation's windows; ``formatted``
    is the text, ``loss`` the code-point spans of it that are trained on (the
    texts of assistant turns that are not repeats), ``repeated`` how many
    turns at its start repeat earlier ones, ``tokens`` the sum of its turns'.

    Turns go by turn number (nulls first), ties by role and a hash of the
    text, so repeated rows are turns of their own. Null texts and roles are
    empty; an empty assistant text has no span. A null id is a conversation
    of its own. An empty table gives no rows; other columns are ignored.
    ``history`` may be ``segment`` at most: every turn has a token, so the
    last ``history`` turns of a segment are all that the next can repeat.
    """
    if history > segment:
        raise ValueError("history must not exceed segment")
    src = turns.select(turns["conv_id"].cast("long").alias("conv_id"), F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
                       F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"), turns["turn"].alias("turn")) \
        .withColumn("th", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "th", "row"]
    numbered = materialize(src.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
                           .mapInArrow(_number, "conv_id long, role string, text string, local long, pid long"))
    runs = numbered.groupBy("conv_id", "pid").agg(F.count("*").alias("n"))
    by_conv = Window.partitionBy("conv_id")
    spans = runs.select(F.col("conv_id").alias("__conv"), F.col("pid").alias("__pid"), F.sum("n").over(by_conv).alias("total"),
                        F.coalesce(F.sum("n").over(by_conv.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset")) \
        .filter(f"offset > 0 OR total > {segment}")
    spans = small(materialize(spans))
    rows = numbered.join(spans, numbered["conv_id"].eqNullSafe(spans["__conv"]) & (F.col("pid") == F.col("__pid")), "left")
    no = F.col("local") + F.coalesce("offset", F.lit(0))
    rows = rows.select("conv_id", "role", "text", no.alias("no"), F.coalesce("total", F.lit(0)).alias("total"))
    own = F.floor(F.col("no") / segment)
    # the last turns of a segment are the next one's history, and its system turn goes to every segment
    copies = F.when((F.col("no") == 0) & (F.col("role") == "system") & (F.col("total") > segment),
                    F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / segment))) \
        .when((F.col("no") % segment >= segment - history) & ((own + 1) * segment < F.col("total")), F.array(own, own + 1)) \
        .otherwise(F.array(own))
    dealt = rows.select("conv_id", F.explode(copies).alias("segment"), "no", "role", "text") \
        .repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "no")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(WINDOW_SCHEMA))
    return dealt.mapInArrow(lambda b: _format(b, tokenizer_path, budget, history, segment, schema), WINDOW_SCHEMA)


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict], repeated: int) -> None:
        turns = read_turns(formatted)[repeated:]
        self.turns += len(turns)
        self.chars += len(formatted)
        for role, text in turns:
            self.all.update(f"{role}\n{text}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"]:span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_back(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    current, out = None, []
    for b in batches:
        for conv, formatted, loss, repeated in zip(*(c.to_pylist() for c in b.columns)):
            if current is None or current.conv_id != conv:
                if current is not None:
                    out.append(current.row())
                current = _Digest(conv)
            current.add(formatted, loss, repeated)
    if current is not None:
        out.append(current.row())
    cols = list(zip(*out)) or [()] * len(schema)
    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests per conversation, read back from the formatted windows.

    The digests run over a conversation's turns in order: one task streams a
    conversation's windows, one at a time.
    """
    from smartmaint.llm.tokens import default_path
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    windows = format_conversations(turns.unionByName(extra), default_path())
    dealt = windows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window").select("conv_id", "formatted", "loss", "repeated")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    schema = to_arrow_schema(_parse_datatype_string(out))
    return dealt.mapInArrow(lambda b: _read_back(b, schema), out)
