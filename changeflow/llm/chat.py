"""Chat formatting: a hidden Markov model recovers who speaks in a plain transcript.

A transcript is lines in order. The state of a line is its speaker's role and whether it
begins a turn; what is seen is the kind of its speaker marker, its length class, its last
character and its first. Probabilities come from counts over all labelled lines (small
tables: states by values), the states of a transcript by Viterbi, and turns are then written in
one canonical form.

Scale: a conversation of any length is decoded in spans of ``SPAN`` lines. A span is summed up
by a matrix of best path scores from each state before it to each state at its end; those are
combined ``FAN`` at a time, level by level, and the best states handed down again, so no task
holds more than a span or ``FAN`` matrices of a conversation, and the path is the exact one.
:func:`transcript_lines` numbers lines without gaps or equal places, so its spans are ``SPAN`` lines.

Defined cases: a null line is an empty one; a null conversation id is a conversation of
its own; lines at equal places are in order of their text; an empty table gives an empty
result; with nothing to learn from, all roles are alike and the first listed wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import cut

ROLES = ("system", "user", "assistant")
SPAN, FAN = 1024, 64
# fixed values: speaker marks by the role they usually stand for; "-" may be anyone's
MARKS = (("system", r"(?:system|instructions)\s*:|\[system\]"),
         ("user", r"(?:user|human|q|customer)\s*:|\[user\]"),
         ("assistant", r"(?:assistant|ai|a|bot)\s*:|\[assistant\]"),
         ("any", r"-\s"))
_PATTERN = r"(?i)^\s*(?:" + "|".join(f"({p})" for _, p in MARKS) + r")\s*"
STATES = [(r, b) for r in range(len(ROLES)) for b in (1, 0)]      # (role, begins a turn)
S = len(STATES)
START = S                                                         # the state before a transcript
_NONE = -1e30


def mark(line: Column) -> Column:
    """0 without a speaker mark, else the place of its kind in ``MARKS``, from 1 on."""
    kinds = [F.when(F.regexp_like(line, F.lit(r"(?i)^\s*(?:" + p + ")")), F.lit(i + 1)) for i, (_, p) in enumerate(MARKS)]
    return F.coalesce(*kinds, F.lit(0))


def observed(line: Column) -> Column:
    """One number for what is seen of a line: mark kind, length class, last character."""
    size = F.length(line)
    length = F.when(size < 40, 0).when(size < 160, 1).when(size < 480, 2).otherwise(3)
    last = F.when(line.endswith("?"), 0).when(line.rlike(r"[.!]\s*$"), 1).otherwise(2)
    return ((mark(line) * 4 + length) * 3 + last).cast("int")


SEEN = (len(MARKS) + 1) * 12


class Hmm:
    """Log probabilities, from counts with one added."""

    def __init__(self, emits: np.ndarray, moves: np.ndarray):
        self.emit = np.log((emits + 1) / (emits + 1).sum(axis=1, keepdims=True))            # (S, SEEN)
        allowed = np.ones((S + 1, S), bool)
        for i, (r, _) in enumerate(STATES):
            for j, (q, begins) in enumerate(STATES):
                allowed[i, j] = begins or q == r                                              # a turn goes on in its role
        allowed[START] = [b == 1 for _, b in STATES]
        p = np.where(allowed, moves + 1, 0)
        with np.errstate(divide="ignore"):
            self.move = np.maximum(np.log(p / p.sum(axis=1, keepdims=True)), _NONE)           # (S + 1, S)


def learn(lines: DataFrame) -> Hmm:
    """Count over all labelled ``lines``: (turn_key, prev_role, role, begins, line)."""
    code = F.coalesce(*[F.when(F.col("role") == r, F.lit(i)) for i, r in enumerate(ROLES)])
    emits, moves = np.zeros((S, SEEN)), np.zeros((S + 1, S))
    before = F.when(F.col("begins") & F.col("prev_role").isNull(), F.lit(START)).otherwise(
        F.coalesce(*[F.when(F.col("prev_role") == r, F.lit(2 * i) + F.when(F.col("prev_one"), 0).otherwise(1))
                     for i, r in enumerate(ROLES)]))
    known = lines.select(code.alias("r"), "begins", before.alias("b"), observed(F.col("line")).alias("o")).where("r is not null")
    # S * SEEN * (S + 2) rows at most
    for x in known.groupBy("r", "begins", "b", "o").agg(F.count(F.lit(1)).alias("n")).collect():
        state = STATES.index((x["r"], int(x["begins"])))
        emits[state, x["o"]] += x["n"]
        if x["b"] is not None:
            moves[x["b"], state] += x["n"]
    return Hmm(emits, moves)


# --- best paths -------------------------------------------------------------------------

def span_matrix(seen: np.ndarray, hmm: Hmm) -> np.ndarray:
    """(S + 1, S): best score from each state before the lines to each state of the last."""
    m = hmm.move + hmm.emit[:, seen[0]]
    for o in seen[1:]:
        m = (m[:, :, None] + hmm.move[None, :S]).max(axis=1) + hmm.emit[:, o]
    return m


def combine(mats: list[np.ndarray]) -> np.ndarray:
    m = mats[0]
    for n in mats[1:]:
        m = (m[:, :, None] + n[None, :S]).max(axis=1)
    return m


def between(mats: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """The best state at the end of each part, from ``enter`` before the first to ``leave`` at the last."""
    score, back = mats[0][enter], []
    for n in mats[1:]:
        all_ = score[:, None] + n[:S]
        back.append(all_.argmax(axis=0))
        score = all_.max(axis=0)
    path = [leave]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def span_path(seen: np.ndarray, hmm: Hmm, enter: int, leave: int) -> list[int]:
    score, back = hmm.move[enter] + hmm.emit[:, seen[0]], []
    for o in seen[1:]:
        all_ = score[:, None] + hmm.move[:S]
        back.append(all_.argmax(axis=0))
        score = all_.max(axis=0) + hmm.emit[:, o]
    path = [leave]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _groups(batches, keys: int) -> Iterator[pa.Table]:
    """Tables of the rows with equal first ``keys`` columns, from batches sorted by them."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
        if not table.num_rows:
            continue
        cols = [table.column(i).to_pylist() for i in range(keys)]
        names = list(zip(*cols, strict=True))
        at = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
        for a, b in zip([0, *at][:-1], at, strict=True):
            yield table.slice(a, b - a)
        kept = table.slice(at[-1] if at else 0)
    if kept is not None and kept.num_rows:
        yield kept


def _sorted(df: DataFrame, keys: list[str], *more) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *more)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _chunked(rows: Iterator[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for r in rows:
        out.append(r)
        if len(out) == size:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _load(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.float64).reshape(S + 1, S)


def decode(lines: DataFrame, hmm: Hmm, span: int = SPAN, fan: int = FAN) -> DataFrame:
    """(conv_id, pos, line, state) of ``lines`` (conv_id, pos, line); pos is a place from 0 on, and
    lines whose place divided by ``span`` is equal are one span. conv_id is a long."""
    shared = lines.sparkSession.sparkContext.broadcast(hmm)
    base = cut(lines.select(F.col("conv_id").cast("long"), F.coalesce(F.col("pos").cast("long"), F.lit(0)).alias("pos"),
                            F.coalesce("line", F.lit("")).alias("line"))
               .withColumn("span", F.floor(F.col("pos") / F.lit(span))).withColumn("seen", observed(F.col("line"))), "lines")
    mat = pa.schema([("conv_id", pa.int64()), ("span", pa.int64()), ("m", pa.binary())])
    ends = pa.schema([("conv_id", pa.int64()), ("span", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32())])

    def leaf(batches):
        yield from _chunked(((g.column(0)[0].as_py(), g.column(1)[0].as_py(),
                              span_matrix(g.column(2).to_numpy(), shared.value).tobytes()) for g in _groups(batches, 2)), mat)

    def up(batches):
        yield from _chunked(((g.column(0)[0].as_py(), g.column(1)[0].as_py(),
                              combine([_load(x.as_py()) for x in g.column(3)]).tobytes()) for g in _groups(batches, 2)), mat)

    def top(batches):
        for batch in batches:
            yield from _chunked(((c.as_py(), s.as_py(), START, int(_load(m.as_py())[START].argmax()))
                                 for c, s, m in zip(*batch.columns, strict=True)), ends)

    def down(batches):
        def rows():
            for g in _groups(batches, 2):
                enter, leave = g.column(4)[0].as_py(), g.column(5)[0].as_py()
                for s, end in zip(g.column(2), between([_load(x.as_py()) for x in g.column(3)], enter, leave), strict=True):
                    yield g.column(0)[0].as_py(), s.as_py(), enter, end
                    enter = end
        yield from _chunked(rows(), ends)

    sql = "conv_id long, span long, m binary"
    levels = [cut(_sorted(base, ["conv_id", "span"], "pos", "line").select("conv_id", "span", "seen").mapInArrow(leaf, sql), "spans")]
    most = levels[0].agg(F.max("span")).first()[0] or 0
    while most > 0:
        grouped = levels[-1].select("conv_id", F.floor(F.col("span") / F.lit(fan)).alias("up"), "span", "m")
        levels.append(cut(_sorted(grouped, ["conv_id", "up"], "span").mapInArrow(up, sql), "spans"))
        most //= fan
    state = levels[-1].mapInArrow(top, "conv_id long, span long, enter int, leave int")
    for level in reversed(levels[:-1]):
        here = level.withColumn("up", F.floor(F.col("span") / F.lit(fan)))
        state = state.select(F.col("conv_id").alias("c"), F.col("span").alias("s"), "enter", "leave")
        joined = here.join(state, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("s")))
        state = cut(_sorted(joined.select("conv_id", "up", "span", "m", "enter", "leave"), ["conv_id", "up"], "span")
                    .mapInArrow(down, "conv_id long, span long, enter int, leave int"), "states")

    def paths(batches):
        for g in _groups(batches, 2):
            enter, leave = g.column("enter")[0].as_py(), g.column("leave")[0].as_py()
            path = span_path(g.column("seen").to_numpy(), shared.value, enter, leave)
            yield pa.RecordBatch.from_arrays([g.column("conv_id").combine_chunks(), g.column("pos").combine_chunks(),
                                              g.column("line").combine_chunks(), pa.array(path, pa.int32())],
                                             names=["conv_id", "pos", "line", "state"])

    state = state.select(F.col("conv_id").alias("c"), F.col("span").alias("s"), "enter", "leave")
    joined = base.join(state, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("span") == F.col("s"))).drop("c", "s")
    done = _sorted(joined.select("conv_id", "span", "pos", "line", "seen", "enter", "leave"), ["conv_id", "span"], "pos", "line")
    return done.mapInArrow(paths, "conv_id long, pos long, line string, state int")


def render(decoded: DataFrame) -> DataFrame:
    """(conv_id, pos, role, begins, rendered): canonical text of each line. The rendered lines of a
    conversation, put together in order, are its canonical transcript, turn by turn."""
    role = F.element_at(F.array(*[F.lit(ROLES[r]) for r, _ in STATES]), F.col("state") + 1)
    begins = F.element_at(F.array(*[F.lit(bool(b)) for _, b in STATES]), F.col("state") + 1)
    plain = F.regexp_replace("line", _PATTERN, "")
    first = F.col("pos") == 0
    text = F.when(F.col("begins"), F.concat(F.when(first, F.lit("")).otherwise(F.lit("<|end|>\n")), F.lit("<|"), "role", F.lit("|>\n"), plain, F.lit("\n"))
                  ).otherwise(F.concat("line", F.lit("\n")))
    return (decoded.withColumn("role", role).withColumn("begins", begins)
            .select("conv_id", "pos", "role", "begins", text.alias("rendered")))


# --- transcripts of the conversations table -----------------------------------------------

BUCKETS, TURNS = 64, 256    # rows of one turn are numbered in buckets, turns in blocks


def places(turns: DataFrame) -> DataFrame:
    """(conv, turn, bucket, base, p): the place of a bucket's first line in its transcript, and the turn before.

    Line counts are summed in blocks of ``TURNS`` turns and over one row for each block, so no window
    holds a whole transcript.
    """
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = (turns.groupBy("conv", "turn", "bucket").agg(F.sum("n").alias("n"), F.max(F.struct("role", "one")).alias("p"))
           .withColumn("block", F.floor(F.col("turn") / F.lit(TURNS))))
    blocks = (per.groupBy("conv", "block").agg(F.sum("n").alias("n"))
              .select("conv", "block", before(Window.partitionBy("conv").orderBy("block")).alias("start")))
    last = per.groupBy("conv", (F.col("turn") + 1).alias("turn")).agg(F.max("p").alias("p"))
    inside = before(Window.partitionBy("conv", "block").orderBy("turn", "bucket"))
    return (per.select("conv", "block", "turn", "bucket", inside.alias("inside")).join(blocks, ["conv", "block"])
            .join(last, ["conv", "turn"], "left")
            .select("conv", "turn", "bucket", (F.col("start") + F.col("inside")).alias("base"), "p"))


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Plain transcripts of ``conversations`` (conv_id, turn, role, text), a row for each line: (conv_id, turn,
    pos, line, role, begins, prev_role, prev_one). Lines are numbered from 0 on without gaps; rows that share a
    turn follow each other by a hash of their text, then by it. Each turn's first line gets one of its role's
    speaker marks, or "-", or none, by a hash of its place; later lines have none."""
    marks = {"system": ["System: ", "Instructions: ", "[system] "], "user": ["User: ", "Human: ", "Q: ", "[user] "],
             "assistant": ["Assistant: ", "AI: ", "A: ", "[assistant] "]}
    pick = F.pmod(F.xxhash64(F.lit("mark"), "conv_id", "turn"), F.lit(20))
    style = F.pmod(F.xxhash64(F.lit("style"), "conv_id"), F.lit(12)).cast("int")
    said = F.when(pick < 3, F.lit("")).when(pick < 5, F.lit("- "))
    for role, all_ in marks.items():
        said = said.when(F.col("role") == role, F.element_at(F.array(*[F.lit(m) for m in all_]), style % len(all_) + 1))
    n = F.size(F.split("text", "\n"))
    # a struct as key: null ids are equal, and the window and the join below share one shuffle
    turns = (conversations.select(F.struct("conv_id").alias("conv"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                                  "role", F.coalesce("text", F.lit("")).alias("text"))
             .select("*", n.alias("n"), (n == 1).alias("one"), F.pmod(F.xxhash64("text", "role"), F.lit(BUCKETS)).alias("bucket")))
    rows = Window.partitionBy("conv", "turn", "bucket").orderBy("text", "role").rowsBetween(Window.unboundedPreceding, -1)
    placed = (turns.withColumn("ahead", F.coalesce(F.sum("n").over(rows), F.lit(0))).join(places(turns), ["conv", "turn", "bucket"])
              .select("conv.conv_id", "turn", "role", "text", (F.col("base") + F.col("ahead")).alias("first"),
                      F.col("p.role").alias("prev_role"), F.col("p.one").alias("prev_one"))
              .withColumn("said", said.otherwise(F.lit(""))))
    lines = placed.select("*", F.posexplode(F.split("text", "\n")).alias("no", "one"))
    begins = F.col("no") == 0
    return lines.select("conv_id", "turn", (F.col("first") + F.col("no")).alias("pos"),
                        F.when(begins, F.concat("said", "one")).otherwise(F.col("one")).alias("line"), "role", begins.alias("begins"),
                        F.when(begins, F.col("prev_role")).otherwise(F.col("role")).alias("prev_role"),
                        F.when(begins, F.col("prev_one")).otherwise(F.col("no") == 1).alias("prev_one"))
