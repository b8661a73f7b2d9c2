"""Transcripts to canonical chat turns: roles recovered by a hidden Markov model.

States are the roles, each at the start of a turn or inside one; what is seen of a line is
its speaker marker and a few features. Probabilities are counted over all conversations with
known roles. The best path is found by Viterbi. Long conversations are cut into segments:
a segment's best scores from each state to each state form a matrix, the matrices of a
conversation chain up to the states at the cuts, and each segment is then decoded alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import small_batches

ROLES = ("system", "user", "assistant")
STATES = [(r, start) for r in ROLES for start in (True, False)]
N = len(STATES)
SEGMENT = 256  # turns

# Names of speakers, and the shapes that markers have.
SPEAKERS = {
    "system": ("system", "sys", "instruction", "instructions"),
    "user": ("user", "human", "customer", "question", "q", "prompter"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "response", "model", "gpt"),
}
_NAMES = "|".join(sorted((n for names in SPEAKERS.values() for n in names), key=len, reverse=True))
MARKER = re.compile(rf"\s*(?:<\|\s*(?:im_start\|>\s*)?({_NAMES})\s*(?:\|>)?|#+\s*({_NAMES})\s*:?\s*$|\[({_NAMES})\]:?|\*{{0,2}}({_NAMES})\*{{0,2}}\s*:\*{{0,2}})\s*", re.I)
ROLE_OF = {n: r for r, names in SPEAKERS.items() for n in names}
MARKERS = ("none", *ROLES)
LENGTHS = (0, 20, 60, 140, 400)
FEATURES = (len(MARKERS), 2, len(LENGTHS) + 1, 2)
FAITH = 1_000.0  # what a marker counts for its role beyond the counted lines


def marker_of(line: str) -> tuple[str, str]:
    """Role that a line's marker names, or "none", and the line without its marker."""
    m = MARKER.match(line)
    return (ROLE_OF[next(g for g in m.groups() if g).lower()], line[m.end() :]) if m else ("none", line)


def seen(line: str, first: bool) -> tuple[int, ...]:
    """What the model sees of a line: marker, whether it opens a row or has one, length, question."""
    marker, rest = marker_of(line)
    return MARKERS.index(marker), int(first or marker != "none"), sum(len(rest) > n for n in LENGTHS), int(rest.rstrip().endswith("?"))


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray
    step: np.ndarray  # from state, to state
    emit: tuple[np.ndarray, ...]  # of each feature: state x value

    def lines(self, features: np.ndarray) -> np.ndarray:
        return sum(e[:, features[:, i]].T for i, e in enumerate(self.emit))


def lines_of(df: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `role`, `line` and `text` of every line; a repeated row is one turn."""
    rows = df.select("conv_id", "turn", F.lower("role").alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    return rows.select("conv_id", "turn", "role", F.col("text").alias("whole"), F.posexplode(F.split("text", "\n")).alias("line", "text"))


def learn(df: DataFrame) -> Hmm:
    """Probabilities counted over all lines with a known role, with one more of everything.

    Changes of role are counted between turns that follow each other in number.
    """
    small_batches(df.sparkSession)

    @F.pandas_udf("marker int, first int, length int, asks int")
    def look(texts: pd.Series, lines: pd.Series) -> pd.DataFrame:
        rows = [seen(t, n == 0) for t, n in zip(texts, lines)]
        return pd.DataFrame(rows, columns=["marker", "first", "length", "asks"])

    lines = lines_of(df).where(F.col("role").isin(*ROLES))
    counts = lines.select("role", (F.col("line") == 0).alias("start"), look("text", "line").alias("f")).groupBy("role", "start", "f").count()
    emit = tuple(np.ones((N, n)) for n in FEATURES)
    inside = {r: 1.0 for r in ROLES}
    begun = {r: 1.0 for r in ROLES}
    for r in counts.collect():  # as many rows as there are states and features
        s = STATES.index((r["role"], r["start"]))
        for i, value in enumerate(r["f"]):
            emit[i][s, value] += r["count"]
        (begun if r["start"] else inside)[r["role"]] += r["count"]
    for s, (role, is_start) in enumerate(STATES):
        if is_start:  # a marker starts a turn of the role that it names
            emit[0][s, MARKERS.index(role)] += FAITH
    turns = df.select("conv_id", "turn", F.lower("role").alias("role")).where(F.col("role").isin(*ROLES)).distinct()
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    moves = turns.join(before, ["conv_id", "turn"], "left").groupBy("before", "role").count().collect()
    start, change = np.full(N, 1e-6), {(a, b): 1.0 for a in ROLES for b in ROLES}
    for r in ROLES:
        start[STATES.index((r, True))] = 1.0
    for m in moves:
        if m["before"] is None:
            start[STATES.index((m["role"], True))] += m["count"]
        else:
            change[m["before"], m["role"]] += m["count"]
    step = np.zeros((N, N))
    for i, (a, _) in enumerate(STATES):
        stay = inside[a] / (inside[a] + begun[a])
        out = sum(change[a, b] for b in ROLES)
        for j, (b, is_start) in enumerate(STATES):
            step[i, j] = (1 - stay) * change[a, b] / out if is_start else (stay if a == b else 1e-12)
    logs = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Hmm(logs(start), logs(step), tuple(logs(e) for e in emit))


def best_from_to(hmm: Hmm, scores: np.ndarray, first: bool) -> np.ndarray:
    """Best scores over a segment, from the state before it (or the start) to its last state."""
    best = np.full((N, N), hmm.start[None, :]) if first else hmm.step.copy()
    best = best + scores[0]
    for row in scores[1:]:
        best = (best[:, :, None] + hmm.step[None]).max(axis=1) + row
    return best


def viterbi(hmm: Hmm, scores: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
    """Best states of the lines, after a given state and up to a given one, where there are."""
    now = (hmm.start if before is None else hmm.step[before]) + scores[0]
    back = np.zeros(scores.shape, np.int8)
    for i, row in enumerate(scores[1:], 1):
        ways = now[:, None] + hmm.step
        back[i] = ways.argmax(axis=0)
        now = ways.max(axis=0) + row
    out = np.empty(len(scores), np.int8)
    out[-1] = now.argmax() if last is None else last
    for i in range(len(scores) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def canonical(role: str, starts: bool, text: str) -> str:
    """A line as it stands in the canonical form; the start of a turn has its role before it."""
    return f"<|{role}|>\n{marker_of(text)[1]}" if starts else text


def recover_roles(df: DataFrame, hmm: Hmm | None = None) -> DataFrame:
    """One row per line: `conv_id`, `turn`, `role` as given, `line`, `found`, `starts`, `rendered`.

    Conversations are read as transcripts without their roles, turns in order (then by text),
    rows without a turn first. A null text is an empty line; rows without conv_id are one
    conversation. Rows that are the same in all four columns are one turn; other columns are
    left out. Joined in order by line ends, `rendered` is the canonical chat.
    """
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast(hmm or learn(df))
    number = F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-(1 << 40)))
    lines = lines_of(df).withColumns({"conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("~")), "seg": number.cast("bigint")})
    firsts = lines.groupBy("conv").agg(F.min("seg").alias("first_seg"), F.max("seg").alias("last_seg"))

    def scored(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        rows = rows.sort_values(["turn", "whole", "role", "line"], na_position="first", kind="stable")
        features = np.array([seen(t, n == 0) for t, n in zip(rows["text"], rows["line"])])
        return rows, shipped.value.lines(features)

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        conv, seg, first = rows["conv"].iloc[0], rows["seg"].iloc[0], rows["first_seg"].iloc[0]
        best = best_from_to(shipped.value, scored(rows)[1], seg == first)
        return pd.DataFrame({"conv": [conv], "seg": [seg], "best": [best.reshape(-1).tolist()]})

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seg")
        total, back = None, []
        for best in rows["best"]:
            best = np.asarray(best).reshape(N, N)
            ways = best[:1] if total is None else total[:, None] + best
            back.append(ways.argmax(axis=0))
            total = ways.max(axis=0)
        ends = [int(total.argmax())]
        for b in back[:0:-1]:
            ends.append(int(b[ends[-1]]))
        ends = ends[::-1]
        return pd.DataFrame({"conv": rows["conv"], "seg": rows["seg"], "before": pd.array([None, *ends[:-1]], "Int64"), "last": ends})

    long = lines.join(firsts.where("first_seg < last_seg"), "conv")
    cuts = long.groupBy("conv", "seg").applyInPandas(cut, "conv string, seg long, best array<double>")
    known = cuts.groupBy("conv").applyInPandas(chain, "conv string, seg long, before long, last long")

    def decode(rows: pd.DataFrame) -> pd.DataFrame:
        rows, scores = scored(rows)
        whole = lambda x: None if pd.isna(x) else int(x)
        states = viterbi(shipped.value, scores, whole(rows["before"].iloc[0]), whole(rows["last"].iloc[0]))
        found = [STATES[s] for s in states]
        return pd.DataFrame(
            {
                "conv_id": rows["conv_id"],
                "turn": rows["turn"],
                "role": rows["role"],
                "whole": rows["whole"],
                "line": rows["line"],
                "found": [r for r, _ in found],
                "starts": [s for _, s in found],
                "rendered": [canonical(r, s, t) for (r, s), t in zip(found, rows["text"])],
            }
        )

    kind = dict(df.dtypes)
    schema = f"conv_id {kind['conv_id']}, turn {kind['turn']}, role string, whole string, line int, found string, starts boolean, rendered string"
    return lines.join(known, ["conv", "seg"], "left").groupBy("conv", "seg").applyInPandas(decode, schema)


def digests(found: DataFrame) -> DataFrame:
    """Each given turn: the role found for it, how many turns start in it, and its canonical form."""
    lines = F.array_sort(F.collect_list(F.struct("line", "found", "starts", "rendered")))
    rows = found.groupBy("conv_id", "turn", "role", "whole").agg(lines.alias("lines"))
    return rows.select(
        "conv_id",
        "turn",
        "role",
        F.col("lines")[0]["found"].alias("found"),
        F.size(F.filter("lines", lambda x: x["starts"])).cast("bigint").alias("n_starts"),
        F.sha2(F.array_join(F.transform("lines", lambda x: x["rendered"]), "\n"), 256).alias("rendered_sha256"),
    )
