"""Transcripts to chat turns by a hidden Markov model over lines.

A state is a role together with whether the line begins a turn or goes on with one. A line is seen as its
speaker marker (the word before a colon, angle or in brackets, by its usual meaning), the shape of its
text, its length, and whether an empty line stands before it. Start, transition and emission
probabilities are counted from labelled transcripts; Viterbi finds the likeliest states, and turns are
rendered in one canonical form.

A transcript may come in several parts, so that none is too long for a task. Each part is summed up by the
scores of the best paths between any two states (a small matrix); these are multiplied along the transcript,
which gives the best state at each part's edges, and the parts are then decoded by themselves. The result is that of one
pass over the whole.

Null and empty texts have no lines and give no turn; rows without a conv_id are left out. Parts with the same number are in
the order of their text. Ties go to the state named first.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import batch, store
from murmur.llm.grouped import groups

ROLES = ("system", "user", "assistant")
STATES = [(r, b) for r in ROLES for b in (True, False)]  # role, begins a turn
N = len(STATES)
SAMPLE = 2_000  # transcripts that the probabilities are counted from
MARK = re.compile(r"^\s*(?:[#*_>\-]*\s*)?(?:\[\s*([^\W\d_][\w ]{0,15}?)\s*\]\s*:?|<\|?\s*([^\W\d_][\w ]{0,15}?)\s*\|?>\s*:?|([^\W\d_][\w ]{0,15}?)\s*(?:[:>»]|[–—-]{1,2}(?=\s)))(?:\s|$)")
# Usual names of speakers.
MEANING = {
    **dict.fromkeys(("system", "sys", "instructions", "instruction", "context", "rules"), 1),
    **dict.fromkeys(("user", "human", "customer", "question", "q", "me", "you", "client", "student", "prompt", "input"), 2),
    **dict.fromkeys(("assistant", "ai", "bot", "agent", "answer", "a", "model", "response", "output", "teacher", "gpt", "helper"), 3),
}
MARKERS, SHAPES, LENGTHS, GAPS = 5, 4, 4, 2
VALUES = (MARKERS, SHAPES, LENGTHS, GAPS)
OPEN, CLOSE = "<|{}|>\n", "\n<|end|>\n"


def marker(line: str) -> tuple[int, int]:
    """Kind of marker (0 none, 1-3 a role's, 4 another name) and where the text after it begins."""
    m = MARK.match(line)
    if not m:
        return 0, 0
    name = (m[1] or m[2] or m[3]).strip().lower()
    return (MEANING[name], m.end()) if name in MEANING else (4, 0)


def features(line: str, gap: bool) -> tuple[int, int, int, int]:
    kind, at = marker(line)
    body = line[at:].rstrip()
    shape = 1 if body.endswith("?") else 2 if re.match(r"\s*(?:[-*•]|\d+[.)])\s", body) else 3 if body[:1].islower() else 0
    n = len(body)
    return kind, shape, (n > 40) + (n > 120) + (n > 400), int(gap)


def lines(text: str) -> list[tuple[str, bool]]:
    """Lines that are not empty, and whether an empty line stands before each."""
    out, gap = [], False
    for x in text.splitlines():
        if x.strip():
            out.append((x, gap))
            gap = False
        else:
            gap = True
    return out


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]  # of each feature: states by values

    def scores(self, seen: list[tuple[int, ...]]) -> np.ndarray:
        f = np.array(seen, np.int64).reshape(-1, len(self.emit))
        return sum(e[:, f[:, k]].T for k, e in enumerate(self.emit))


def _prior() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    start, move = np.full(N, 0.1), np.full((N, N), 0.1)
    emit = [np.full((N, n), 0.01) for n in VALUES]
    for s, (_, begins) in enumerate(STATES):
        # a turn goes on in its own role only
        for t, (role, again) in enumerate(STATES):
            if not again and role != STATES[s][0]:
                move[s, t] = 1e-9
        if not begins:
            start[s] = 1e-9
    return start, move, emit


def _normed(start, move, emit) -> Model:
    norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Model(norm(start), norm(move), [norm(e) for e in emit])


def fit(labelled: list[list[tuple[str, str]]]) -> Model:
    """Count probabilities from transcripts given as turns of (role, text with its marker)."""
    start, move, emit = _prior()
    for turns in labelled:
        last = None
        for role, text in turns:
            if role not in ROLES:
                continue
            for i, (x, gap) in enumerate(lines(text)):  # an empty line before a turn leads its text
                s = STATES.index((role, i == 0))
                if last is None:
                    start[s] += 1
                else:
                    move[last, s] += 1
                for e, v in zip(emit, features(x, gap), strict=True):
                    e[s, v] += 1
                last = s
    return _normed(start, move, emit)


def in_parts(turns: DataFrame, size: int) -> DataFrame:
    """(conv_id, part, place, role, line) of (conv_id, turn, role, line): ``size`` turns in each part, however they are numbered.

    Turns are in the order of their number, those without one first, and of their line. Rows without a conv_id are left out.
    """
    given = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "line")
    # numbered by stretches of turn numbers, so that a long transcript doesn't meet in one task
    stretch = F.coalesce(F.floor(F.col("turn") / size), F.lit(-(1 << 62))).alias("stretch")
    given = given.where("conv_id IS NOT NULL").select("*", stretch)
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = given.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    offsets = sizes.select("conv_id", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("conv_id", "stretch").orderBy("turn", "line")) - 1
    placed = given.withColumn("own", own).join(offsets, ["conv_id", "stretch"]).withColumn("place", F.col("offset") + F.col("own"))
    return placed.select("conv_id", F.floor(F.col("place") / size).alias("part"), "place", "role", "line")


def fit_parts(turns: DataFrame) -> Model:
    """As ``fit``, from (conv_id, part, place, role, line): tasks read the lines, the driver gets sums of counts."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int64()), ("place", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("counts", pa.map_(pa.int32(), pa.int64()))]
    )

    def run(batches):
        for b in batches:
            out = []
            for conv_id, part, place, role, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                counts: Counter[int] = Counter()
                first = last = None
                for i, (x, gap) in enumerate(lines(line)):
                    s = STATES.index((role, i == 0))
                    if last is None:
                        first = s
                    else:
                        counts[last * N + s] += 1
                    for k, v in enumerate(features(x, gap)):
                        counts[N * N + (k * N + s) * max(VALUES) + v] += 1
                    last = s
                if first is not None:
                    out.append((conv_id, part, place, first, last, list(counts.items())))
            if out:
                yield batch(schema.names, zip(*out, strict=True), schema)

    given = turns.where(F.col("role").isin(*ROLES)).select("conv_id", "part", "place", "role", "line")
    kinds = "conv_id long, part long, place long, first int, last int, counts map<int,bigint>"
    seen = store(given.mapInArrow(run, kinds), "chat")
    start, move, emit = _prior()
    for code, n in seen.select(F.explode("counts").alias("code", "n")).groupBy("code").agg(F.sum("n")).collect():
        if code < N * N:
            move[divmod(code, N)] += n
        else:
            where, v = divmod(code - N * N, max(VALUES))
            k, s = divmod(where, N)
            emit[k][s, v] += n
    # from turn to turn inside the parts, then from part to part
    inside = Window.partitionBy("conv_id", "part").orderBy("place")
    edges = seen.groupBy("conv_id", "part").agg(F.min_by("first", "place").alias("first"), F.max_by("last", "place").alias("last"))
    across = Window.partitionBy("conv_id").orderBy("part")
    steps = seen.select(F.lag("last").over(inside).alias("prev"), "first").where("prev IS NOT NULL")
    steps = steps.unionByName(edges.select(F.lag("last").over(across).alias("prev"), "first"))
    for prev, first, n in steps.groupBy("prev", "first").count().collect():
        if prev is None:
            start[first] += n
        else:
            move[prev, first] += n
    return _normed(start, move, emit)


def viterbi(model: Model, scores: np.ndarray, entry: np.ndarray, last: int | None = None) -> tuple[list[int], float]:
    """Likeliest states of some lines: ``entry`` has the score of coming to each state at the first line."""
    best, back = entry + scores[0], []
    for row in scores[1:]:
        ways = best[:, None] + model.move
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + row
    s = int(best.argmax()) if last is None else last
    path = [s]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], float(best[s])


def summary(model: Model, scores: np.ndarray) -> np.ndarray:
    """Score of the best way from each first state to each last state of some lines."""
    best = np.where(np.eye(N, dtype=bool), scores[0][:, None], -np.inf)
    for row in scores[1:]:
        best = (best[:, :, None] + model.move[None]).max(axis=1) + row
    return best


def _edges(parts: DataFrame, model: Model) -> DataFrame:
    """(conv_id, part, text, entry, last): the state a part ends in, and the state before it."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("ways", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            ways = []
            for x in b.column(2).to_pylist():
                seen = [features(line, gap) for line, gap in lines(x)]
                ways.append(summary(model, model.scores(seen)).ravel().tolist() if seen else None)
            yield batch(schema.names, [b.column(0), b.column(1), b.column(2), ways], schema)

    with_ways = parts.mapInArrow(run, "conv_id long, part long, text string, ways array<double>").where("ways IS NOT NULL")
    ordered = Window.partitionBy("conv_id").orderBy("part", "text")
    return with_ways.withColumn("place", F.row_number().over(ordered).cast("long"))


def _states(edges: DataFrame, model: Model) -> DataFrame:
    """(conv_id, place, before, last) from the matrices of a transcript's parts, one small row each."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("before", pa.int32()), ("last", pa.int32())])

    def run(batches):
        for g in groups(batches, "conv_id"):
            ways = np.array(g.column("ways").to_pylist()).reshape(-1, N, N)
            best, back = (model.start[:, None] + ways[0]).max(axis=0), []
            for w in ways[1:]:
                # from the last state of one part over the first state of the next to its last
                step = (model.move[:, :, None] + w[None]).max(axis=1)
                both = best[:, None] + step
                back.append(both.argmax(axis=0))
                best = both.max(axis=0)
            last = [int(best.argmax())]
            for b in reversed(back):
                last.append(int(b[last[-1]]))
            last.reverse()
            yield batch(schema.names, [g.column("conv_id"), g.column("place"), [-1, *last[:-1]], last], schema)

    small = edges.select("conv_id", "place", "ways").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return small.mapInArrow(run, "conv_id long, place long, before int, last int")


def parse(parts: DataFrame, model: Model) -> DataFrame:
    """(conv_id, part, turn, role, text, continued) of (conv_id, part, text): the turns of each part in order.

    ``continued`` marks a first piece that goes on with the turn of the part before.
    """
    given = parts.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("part").cast("long").alias("part"), "text")
    given = given.where("conv_id IS NOT NULL AND text IS NOT NULL")
    edges = _edges(given, model)
    placed = edges.join(_states(edges, model), ["conv_id", "place"]).select("conv_id", "place", "text", "before", "last")
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("continued", pa.bool_())]
    )

    def run(batches):
        for b in batches:
            out = []
            for conv_id, part, text, before, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = lines(text)
                seen = [features(line, gap) for line, gap in own]
                entry = model.start if before < 0 else model.move[before]
                path, _ = viterbi(model, model.scores(seen), entry, last)
                turns: list[list] = []
                for (line, gap), s in zip(own, path, strict=True):
                    role, begins = STATES[s]
                    if begins or not turns:
                        kind, at = marker(line)
                        turns.append([role, [line[at:].strip()], not begins])
                    else:
                        turns[-1][1] += ["", line.rstrip()] if gap else [line.rstrip()]
                out += [(conv_id, part, i, r, "\n".join(x).strip(), c) for i, (r, x, c) in enumerate(turns)]
            if out:
                yield batch(schema.names, zip(*out, strict=True), schema)

    return placed.mapInArrow(run, "conv_id long, part long, turn int, role string, text string, continued boolean")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, part, turn, role, rendered): each turn in canonical form.

    A turn that spans parts is opened in its first piece and closed in its last.
    """
    order = Window.partitionBy("conv_id").orderBy("part", "turn")
    goes_on = F.coalesce(F.lead("continued").over(order), F.lit(False))
    opening = F.when(F.col("continued"), "\n").otherwise(F.format_string(OPEN.replace("{}", "%s"), "role"))
    closing = F.when(goes_on, "").otherwise(CLOSE)
    return turns.select("conv_id", "part", "turn", "role", F.concat(opening, "text", closing).alias("rendered"))
