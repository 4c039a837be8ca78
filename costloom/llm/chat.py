"""Chat formatting: a hidden Markov model recovers who speaks in a raw transcript.

A transcript is the lines of its pieces in order. States are (role, first or later line of a
turn). A line emits three independent features: its speaker marker (``User:``, ``### Human:``,
``Assistant>`` and the like, or none), a length class, and whether it ends as a question.
Start, transition and emission probabilities are smoothed counts over labelled transcripts,
gathered by one aggregate. Viterbi gives the states; each first-line state opens a turn, which
is rendered canonically as ``<|role|>\\ncontent<|end|>\\n`` without its marker.

Long conversations: rows are range-sorted by (conv_id, turn, text) and cut into blocks of at
most ``block`` rows. In the (max, +) algebra a block is one matrix of 6 x 6 scores, so only these
matrices of a conversation meet in one task, to choose the states at the blocks' borders;
each block is then decoded by itself between them.

Defined cases: a null text is one empty line; a null conv_id is a conversation of its own; a
null turn sorts first, equal turns by text; repeated rows are repeated pieces; labels with a
null or unknown role teach nothing; without labels all probabilities are uniform and markers
alone cannot decide; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.common import materialize

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # role r: 2 r on a turn's first line, 2 r + 1 on later ones
MARKERS = {"system": 1, "context": 1, "user": 2, "human": 2, "customer": 2, "question": 2, "q": 2, "assistant": 3, "ai": 3,
           "bot": 3, "model": 3, "answer": 3, "a": 3}
MARKER = re.compile(r"^\s*(?:#+\s*|\[|<\|?)?(" + "|".join(sorted(MARKERS, key=len, reverse=True)) + r")\s*(?:\|?>|\]\s*:?|:)[ \t]*", re.I)
LENGTHS = np.array([1, 20, 60, 150, 400])
SHAPE = (4, len(LENGTHS) + 1, 2)


@dataclass(frozen=True)
class ChatParams:
    block: int = 512
    smoothing: float = 0.1


def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


def observe(line: str) -> int:
    """The line's features as one number."""
    m = MARKER.match(line)
    body = line[m.end():] if m else line
    return int(np.ravel_multi_index((MARKERS[m[1].lower()] if m else 0, int(np.searchsorted(LENGTHS, len(body.strip()), "right")),
                                     int(body.rstrip().endswith("?"))), SHAPE))


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # state x observation

    def matrix(self, observations: list[int], first: bool) -> np.ndarray:
        """Scores of the best paths from the state before these lines to that of the last. For
        a conversation's first lines all rows are alike and start it."""
        out = None
        for o in observations:
            step = (np.tile(self.start, (STATES, 1)) if first and out is None else self.move) + self.emit[:, o]
            out = step if out is None else (out[:, :, None] + step[None]).max(1)
        return out

    def path(self, observations: list[int], before: int, last: int) -> list[int]:
        """Best states with the state before (-1: a conversation starts here) and the last one fixed."""
        score, back = None, []
        for o in observations:
            if score is None:
                score = (self.start if before < 0 else self.move[before]) + self.emit[:, o]
            else:
                all_ = score[:, None] + self.move
                back.append(all_.argmax(0))
                score = all_.max(0) + self.emit[:, o]
        states = [last]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        return states[::-1]


def fit(labelled: DataFrame, params: ChatParams = ChatParams()) -> Model:
    """Counts over labelled pieces (conv_id, turn, role, text): each row is one turn."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit = np.zeros(STATES, np.int64), np.zeros((STATES, STATES), np.int64), np.zeros((STATES, int(np.prod(SHAPE))), np.int64)
        for b in batches:
            for role, before, text in zip(*(b.column(c).to_pylist() for c in ("role", "before", "text"))):
                r, lines = ROLES.index(role), lines_of(text)
                for i, line in enumerate(lines):
                    emit[2 * r + (i > 0), observe(line)] += 1
                if before is None:
                    start[2 * r] += 1
                elif before in ROLES:
                    move[2 * ROLES.index(before), 2 * r] += 1
                if len(lines) > 1:
                    move[2 * r, 2 * r + 1] += 1
                    move[2 * r + 1, 2 * r + 1] += len(lines) - 2
        flat = np.concatenate([start, move.ravel(), emit.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tolist()], pa.list_(pa.int64()))], ["n"])

    known = labelled.where(F.col("role").isin(*ROLES)).select("conv_id", "turn", "role", "text")
    # the turn before: an equi-join on the turn number, so that a long conversation is no hot group
    earlier = known.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before")).dropDuplicates(["conv_id", "turn"])
    rows = known.join(earlier, ["conv_id", "turn"], "left").select("role", F.when(F.col("turn") > 0, F.coalesce("before", F.lit("?"))).alias("before"), "text")
    got = (rows.mapInArrow(count, "n array<long>").select(F.posexplode("n").alias("i", "n")).where("n > 0").groupBy("i").agg(F.sum("n").alias("n")).collect())
    flat = np.zeros(STATES + STATES ** 2 + STATES * int(np.prod(SHAPE)))
    for r in got:
        flat[r["i"]] = r["n"]
    start, move, emit = np.split(flat, [STATES, STATES + STATES ** 2])
    move = move.reshape(STATES, STATES)
    turns = move[::2, ::2].copy()
    for r in range(len(ROLES)):  # a turn ends after its first line or after a later one
        ended, many = turns[r], move[2 * r, 2 * r + 1]
        share = many / max(many + ended.sum(), 1)
        move[2 * r, ::2], move[2 * r + 1, ::2] = ended * (1 - share), ended * share
    norm = lambda a: np.log((a + params.smoothing) / (a + params.smoothing).sum(-1, keepdims=True))
    start[1::2] = 0
    model = Model(norm(start), norm(move), norm(emit.reshape(STATES, -1)))
    model.start[1::2] = -1e6  # a conversation starts with a first line
    for r in range(len(ROLES)):  # a later line follows a line of its own turn
        others = [s for s in range(STATES) if s // 2 != r]
        model.move[others, 2 * r + 1] = -1e6
    return model


def parse(pieces: DataFrame, model: Model, params: ChatParams = ChatParams()) -> DataFrame:
    """(conv_id, turn, segment, opens, role, content, rendered): the turns found in each piece
    (conv_id, turn, text). A segment that does not open a turn goes on with the one before."""
    shared = pieces.sparkSession.sparkContext.broadcast(model)
    rows = pieces.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shift = params.block.bit_length() - 1
    ordered = materialize(rows.orderBy("conv_id", "turn", "text").select("*", F.monotonically_increasing_id().alias("place"))
                          .withColumn("block", F.shiftright("place", shift)), "chat-order")
    key = F.coalesce("conv_id", F.lit(-2 ** 63)).alias("key")
    firsts = materialize(ordered.groupBy(key).agg(F.min("place").alias("first")), "chat-first")

    def score(table: pa.Table) -> pa.Table:
        t = table.sort_by("place")
        first = t.column("place")[0].as_py() == t.column("first")[0].as_py()
        obs = [observe(x) for text in t.column("text").to_pylist() for x in lines_of(text)]
        return pa.table({"key": t.column("key")[:1], "block": t.column("block")[:1], "starts": pa.array([first]),
                         "scores": pa.array([shared.value.matrix(obs, first).ravel().tolist()], pa.list_(pa.float64()))})

    keyed = ordered.withColumn("key", key).join(firsts, "key")
    blocks = materialize(keyed.select("key", "block", "place", "first", "text").groupBy("key", "block")
                         .applyInArrow(score, "key long, block long, starts boolean, scores array<double>"), "chat-blocks")

    def borders(table: pa.Table) -> pa.Table:
        t = table.sort_by("block")
        m = np.array(t.column("scores").to_pylist()).reshape(-1, STATES, STATES)
        total, back = m[0][0], []
        for x in m[1:]:
            all_ = total[:, None] + x
            back.append(all_.argmax(0))
            total = all_.max(0)
        last = [int(total.argmax())]
        for b in reversed(back):
            last.append(int(b[last[-1]]))
        last = last[::-1]
        return pa.table({"key": t.column("key"), "block": t.column("block"), "before": pa.array([-1, *last[:-1]], pa.int32()), "last": pa.array(last, pa.int32())})

    ends = materialize(blocks.select("key", "block", "scores").groupBy("key").applyInArrow(borders, "key long, block long, before int, last int"), "chat-borders")

    def render(table: pa.Table) -> pa.Table:
        t = table.sort_by("place")
        texts = [lines_of(x) for x in t.column("text").to_pylist()]
        obs = [observe(x) for lines in texts for x in lines]
        states = iter(shared.value.path(obs, t.column("before")[0].as_py(), t.column("last")[0].as_py()))
        out: list[tuple] = []
        for conv, turn, lines in zip(t.column("conv_id").to_pylist(), t.column("turn").to_pylist(), texts):
            segments: list[list] = []
            for line in lines:
                s = next(states)
                if s % 2 == 0 or not segments:
                    segments.append([s % 2 == 0, ROLES[s // 2], []])
                    line = MARKER.sub("", line, count=1) if s % 2 == 0 else line
                segments[-1][2].append(line)
            for i, (opens, role, body) in enumerate(segments):
                content = "\n".join(body)
                out.append((conv, turn, i, opens, role, content, f"<|{role}|>\n{content}<|end|>\n"))
        types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string())
        names = ("conv_id", "turn", "segment", "opens", "role", "content", "rendered")
        return pa.table({n: pa.array(c, ty) for n, c, ty in zip(names, zip(*out), types)})

    return (ordered.withColumn("key", key).join(ends, ["key", "block"]).select("key", "block", "place", "conv_id", "turn", "text", "before", "last")
            .groupBy("key", "block").applyInArrow(render, "conv_id long, turn long, segment int, opens boolean, role string, content string, rendered string"))


def transcript(conversations: DataFrame) -> DataFrame:
    """The conversations as raw transcripts: most turns start with a speaker marker in one of
    four styles, by a hash of the conversation; about one turn in eight has none."""
    role, style = F.lower("role"), F.pmod(F.xxhash64("conv_id"), F.lit(4))
    name = F.when(role == "user", F.when(style == 1, "Human").otherwise("User")).when(role == "assistant", F.when(style == 1, "AI").otherwise("Assistant")).otherwise(F.initcap(role))
    mark = F.when(style == 2, F.concat(F.lit("### "), name, F.lit(": "))).when(style == 3, F.concat(F.lit("["), name, F.lit("] "))).otherwise(F.concat(name, F.lit(": ")))
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0) | role.isNull()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.select("conv_id", "turn", role.alias("role"), F.when(bare, text).otherwise(F.concat(mark, text)).alias("text"))
