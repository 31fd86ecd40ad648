"""Chat formatting: conversations as training windows of a token budget.

Turns carry marks of their roles; control strings inside texts are escaped,
reversibly.  Prefix sums over the turns' tokens choose spans of whole turns
by binary search: each window holds the leading system turn, some turns of
history repeated from the window before, and as many new turns as its budget
takes.  Only the texts of new assistant turns stand under the loss mask, so
every target is learnt once, however often it is repeated as context.

Prefix sums run within a conversation, or within a segment of 64 budgets of
a long one: a conversation that holds a third of all turns is cut into
segments that tasks format independently.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import lean, quoted
from fieldbook.operators.ids import dense_ids
from fieldbook.session import materialize

#: The marks that open and close a turn's text, by role.  Any other role is named before its turn.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
NAME_MARKS = ("[ROLE]", "[/ROLE]")
_TAIL = r"(/?s>|</?SYS>>|/?INST\]|/?ROLE\])"
ESCAPE = r"([<\[])(\\*)" + _TAIL
UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _TAIL)
TURN = re.compile(r"<<SYS>>(?P<system>.*?)<</SYS>>|(?:\[ROLE\](?P<name>.*?)\[/ROLE\])?\[INST\](?P<user>.*?)\[/INST\]"
                  r"|<s>(?P<assistant>.*?)</s>", re.S)
MARK_TOKENS = 2  # what the marks of a turn count
SEGMENT = 64  # budgets of a segment
_RUN = 4096  # turns whose tokens are summed together

_WINDOW_DDL = ("conv_id long, segment long, window int, system_turns int, history_turns int, new_turns int, "
               "n_tokens long, text string, loss array<struct<start:long,end:long>>")


def escaped(text: Column) -> Column:
    """One more backslash after the first character of every control string, escaped ones included."""
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit(r"$1\\$2$3"))


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


def estimated_tokens(text: Column) -> Column:
    """A quarter of the text's bytes, rounded up: the usual estimate where no tokenizer's count is given."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def _turns(conversations: DataFrame, tokens_col: str | None) -> DataFrame:
    text = F.coalesce(quoted("text").cast("string"), F.lit(""))
    tokens = estimated_tokens(text) if tokens_col is None else F.coalesce(quoted(tokens_col).cast("long"), F.lit(0))
    return conversations.select(
        quoted("conv_id").cast("long").alias("conv_id"), quoted("turn").cast("long").alias("turn"),
        F.coalesce(quoted("role").cast("string"), F.lit("")).alias("role"), text.alias("text"),
        (F.greatest(tokens, F.lit(0)) + MARK_TOKENS).alias("tokens"))


def _same_conv(a: DataFrame, b: DataFrame, *more: str) -> Column:
    on = a["conv_id"].eqNullSafe(b["conv_id"])
    for c in more:
        on = on & a[c].eqNullSafe(b[c])
    return on


def _segments(turns: DataFrame, size: int) -> DataFrame:
    """(conv_id, turn, before, segment) of long conversations: tokens before a turn, by sums of sums."""
    per_turn = turns.groupBy("conv_id", "turn").agg(F.sum("tokens").alias("tokens"))
    runs = dense_ids(per_turn, ["turn"], id_col="pos", start=0, partition_by=["conv_id"]).withColumn(
        "run", F.floor(F.col("pos") / _RUN).cast("long"))
    inside = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("conv_id", "run").agg(F.sum("tokens").alias("t")).select(
        F.col("conv_id").alias("c"), F.col("run").alias("r"), F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("offset"))
    at = runs.withColumn("within", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    before = F.col("offset") + F.col("within")
    return at.join(sums, at["conv_id"].eqNullSafe(sums["c"]) & (at["run"] == sums["r"])).select(
        "conv_id", "turn", before.alias("before"), F.floor(before / size).cast("long").alias("segment"))


def _prepared(conversations: DataFrame, budget: int, history: int, tokens_col: str | None, segment: int):
    """(turns of short conversations, turns of long ones with segments and what these repeat)."""
    if budget < 1 or not 0 <= history < budget:
        raise ValueError("budget: 1 or more; history: 0 or more and below the budget")
    turns = _turns(conversations, tokens_col)
    size = budget * segment
    long_ids = materialize(turns.groupBy("conv_id").agg(F.sum("tokens").alias("t")).filter(F.col("t") > size)
                           .select("conv_id"), "chat-long")
    short = turns.join(long_ids, _same_conv(turns, long_ids), "left_anti").select(
        "*", F.lit(0).cast("long").alias("segment"), F.lit(0).alias("part"))
    long = turns.join(long_ids, _same_conv(turns, long_ids), "left_semi")
    places = materialize(_segments(long, size), "chat-segments")
    placed = long.join(places, _same_conv(long, places, "turn")).select(*[long[c] for c in long.columns], "before", "segment")
    own = placed.select(*turns.columns, "segment", F.lit(2).alias("part"))
    # what the next segment may repeat as history
    tail = placed.filter(F.col("before") >= (F.col("segment") + 1) * size - history).select(
        *turns.columns, (F.col("segment") + 1).alias("segment"), F.lit(1).alias("part"))
    # a conversation's first row, if it is a system turn, goes to all its segments
    lead = long.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("f")).filter(
        F.col("f.role") == "system").select("conv_id", "f.*")
    later = places.filter("segment > 0").select(F.col("conv_id").alias("c"), "segment").distinct()
    system = lead.join(later, lead["conv_id"].eqNullSafe(later["c"])).select(
        *turns.columns, "segment", F.lit(0).alias("part"))
    return short, own.unionByName(tail).unionByName(system)


def spans(ends: list[int], system: int, led: bool, start: int, budget: int, history: int) -> list[tuple[int, int, int]]:
    """Windows (first history turn, first new turn, end) over turns whose tokens have the prefix sums ``ends``.

    ``ends[k]`` is the sum of the first k turns.  ``led``: turn 0 is the system turn, with ``system`` tokens; windows
    that begin later get it in front.  New turns begin at ``start``.  History is the longest stretch of whole turns of at
    most ``history`` tokens that leaves room for the first new turn; a turn larger than all room stands in a window alone.
    """
    out, s, n = [], start, len(ends) - 1
    low = 1 if led else 0
    while s < n:
        front = system if led and s > 0 else 0
        h = bisect_left(ends, max(ends[s] - history, ends[s + 1] + front - budget), min(s, low), s)
        e = max(s + 1, bisect_right(ends, ends[h] + budget - front, s + 1) - 1)
        out.append((h, s, e))
        s = e
    return out


def _former(budget: int, history: int):
    def windows(conv, segment, rows):
        """Rows (part, role, piece, open, body, tokens) of one segment in order."""
        led = rows[0][1] == "system" and (segment == 0 or rows[0][0] == 0)
        start = sum(1 for r in rows if r[0] < 2) if segment else 0
        ends = [0]
        for r in rows:
            ends.append(ends[-1] + r[5])
        system = rows[0][5] if led else 0
        for k, (h, s, e) in enumerate(spans(ends, system, led, start, budget, history)):
            with_system = led and s > 0
            pieces = [rows[0][2]] if with_system else []
            at = len(pieces[0]) if pieces else 0
            loss = []
            for r in rows[h:e]:
                pieces.append(r[2])
            for i in range(h, e):
                role, piece, lead, body = rows[i][1], rows[i][2], rows[i][3], rows[i][4]
                if i >= s and role == "assistant":
                    loss.append({"start": at + lead, "end": at + lead + body})
                at += len(piece)
            yield (conv, segment, k, int(with_system), s - h, e - s,
                   ends[e] - ends[h] + (system if with_system else 0), "".join(pieces), loss)

    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("window", pa.int32()),
                        ("system_turns", pa.int32()), ("history_turns", pa.int32()), ("new_turns", pa.int32()),
                        ("n_tokens", pa.int64()), ("text", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def table(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], schema.field(i).type) for i in range(len(schema))], schema=schema)

    def run(batches):
        key, rows, out, size = None, [], [], 0

        def full():
            nonlocal size
            made = list(windows(*key, rows))
            out.extend(made)
            size += sum(len(w[7]) for w in made)

        for batch in batches:
            cols = batch.to_pydict()
            for r in zip(*[cols[c] for c in ("conv_id", "segment", "part", "role", "piece", "lead", "body", "tokens")]):
                if r[:2] != key:
                    if rows:
                        full()
                        if size > 1 << 22:
                            yield table(out)
                            out, size = [], 0
                    key, rows = r[:2], []
                rows.append(r[2:])
        if rows:
            full()
        if out:
            yield table(out)
    return run


def _formed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Windows of prepared turns, those of a segment in order and in one task."""
    role = F.col("role")
    opening, closing = F.lit(NAME_MARKS[0]), F.lit(NAME_MARKS[1])
    name = F.concat(opening, escaped(role), closing)
    lead = F.concat(name, F.lit(MARKS["user"][0]))
    tail = F.lit(MARKS["user"][1])
    for known, (a, b) in MARKS.items():
        lead, tail = F.when(role == known, F.lit(a)).otherwise(lead), F.when(role == known, F.lit(b)).otherwise(tail)
    body = escaped(F.col("text"))
    # a number of each row in its segment: bounded groups, sorted once for numbering and formatting
    order = Window.partitionBy("conv_id", "segment").orderBy("part", "turn", "role", "text")
    rows = turns.withColumn("place", F.row_number().over(order)).select(
        "conv_id", "segment", F.col("part").cast("int").alias("part"), "role", F.concat(lead, body, tail).alias("piece"),
        F.char_length(lead).alias("lead"), F.char_length(body).alias("body"), "tokens", "place")
    return rows.mapInArrow(lean(_former(budget, history)), _WINDOW_DDL)


def format_chats(conversations: DataFrame, budget: int = 1024, history: int = 256, tokens_col: str | None = None,
                 segment: int = SEGMENT) -> DataFrame:
    """Training windows of ``conversations(conv_id, turn, role, text)``.

    One row a window: conv_id, segment, window (from 0 in its segment), system_turns (1: the system turn stands in front
    as a repeat), history_turns (repeated next), new_turns, n_tokens, text, and ``loss``: the code point ranges of the
    new assistant texts in ``text``.  Over all windows of a conversation, by (segment, window), the new turns are its
    turns, each once.

    Rows stand by turn (null first, ties by role and text).  Null texts and roles are empty; a null conv_id is a
    conversation of its own; repeated rows are turns each; an empty table gives no rows; other columns are not looked at.
    The system turn is a conversation's first row, if that has the role system.  A turn's tokens are ``tokens_col`` (null:
    0) or else a quarter of its bytes, and 2 for its marks.  Texts are never cut: a turn larger than the budget stands in
    a window of its own that exceeds it.  Rows of one turn number stay together, whatever their size.
    """
    short, long = _prepared(conversations, budget, history, tokens_col, segment)
    return _formed(short, budget, history).unionByName(_formed(long, budget, history))


def parse(text: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted window."""
    out, at = [], 0
    for m in TURN.finditer(text):
        if m.start() != at:
            raise ValueError("text outside turns")
        at, role = m.end(), m.lastgroup
        named = m.group("name")
        out.append((unescape(named) if named is not None else role, unescape(m.group(role))))
    if at != len(text):
        raise ValueError("text outside turns")
    return out


def _reader():
    """Digests of conversations, read back from their windows; those of a conversation come one after another."""
    def run(batches):
        key, state, out = (), None, []

        def done():
            out.append((key[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for w in batch.to_pylist():
                if (w["conv_id"],) != key:
                    if state:
                        done()
                    key, state = (w["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = w["text"]
                for role, body in parse(text)[w["system_turns"] + w["history_turns"]:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for part in w["loss"]:
                    body = unescape(text[part["start"]:part["end"]])
                    state[2] += len(body)
                    state[3].update(body.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
                    out = []
        if state:
            done()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return run


_REPORT_DDL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long")


def chat_report(conversations: DataFrame, budget: int = 1024, history: int = 256, tokens_col: str | None = None,
                segment: int = SEGMENT) -> DataFrame:
    """Per conversation what its windows give back: digests of all turns and of the texts under the loss mask.

    The windows are parsed in the tasks that make them.  Only those of conversations cut into segments are shuffled, to
    be read in order: a SHA-256 is a chain, so one conversation is one stream, of which a task holds a batch at a time.
    """
    short, long = _prepared(conversations, budget, history, tokens_col, segment)
    cut = _formed(long, budget, history).repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    columns = ["conv_id", "system_turns", "history_turns", "text", "loss"]
    read = lean(_reader())
    return _formed(short, budget, history).select(*columns).mapInArrow(read, _REPORT_DDL).unionByName(
        cut.select(*columns).mapInArrow(read, _REPORT_DDL))
