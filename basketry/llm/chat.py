"""Roles of the speakers in transcripts, by a hidden Markov model over line features.

A transcript is a sequence of paragraphs; a line that begins with a speaker's marker begins a paragraph,
too. What is seen of a paragraph: the marker, the size of the paragraph, its number of lines, and the mark
it ends with. What is hidden: who speaks, and whether the paragraph opens a turn or goes on with one. The
model is counted from transcripts with known roles that are not held out, at most about `most` of them. A
marker speaks for opening a turn of its role from the beginning (a prior to which the counts are added),
since transcripts to learn from may have none. The most likely sequence is found by Viterbi's method, and
the paragraphs are rendered as canonical turns: an opening paragraph gets its role's header, and a marker
goes where the paragraph was found to open a turn of the marker's role. Other markers are left as text.

Paragraphs are put in order over all partitions, so that a transcript of any length is spread over
several. Runs of at most RUN paragraphs are the units: for transcripts of several runs, each run is
first reduced to the best score from each state before it to each state at its end; the states between
runs follow from these few numbers, and the runs are then decoded each on its own.

Null or blank text is one empty paragraph. Null ids are an id like any other and are never learned
from; null turns come first; rows with the same id and turn are in order of their text, over all
partitions. Unknown (null)
roles are not learned from. Without any example all roles are null. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.scratch import stored

RUN = 512
MOST = 20_000
MARKER = re.compile(
    r"\s*(?:<\|(?P<tag>[A-Za-z]+)\|>|\[(?P<box>[A-Za-z]+)\]|[#*]*\s*(?P<name>[A-Za-z]{1,12})[*]*\s*[:>])\s*"
)
# What speakers are called in markers; other names are no markers.
NAMES = {
    name: kind
    for kind, names in enumerate(
        (
            ("system", "sys", "instruction", "instructions", "context"),
            ("user", "human", "q", "question", "customer", "me", "prompter"),
            ("assistant", "ai", "bot", "a", "answer", "agent", "model", "gpt"),
        ),
        1,
    )
    for name in names
}
MARKERS, SIZES, LINES, ENDS = 4, 16, 8, 4
# Examples that a role is taken to have with its own marker, and with one of another role or in the
# midst of a turn.
OWN_MARKER, OTHER_MARKER = 1.0, 1e-7
FEATURES = (MARKERS, SIZES, LINES, ENDS)
BREAK = re.compile(r"\n[ \t]*\n\s*")


def paragraphs(text: str | None) -> list[str]:
    """The paragraphs of a text: cut at blank lines, and before lines with a marker."""
    found = []
    for paragraph in BREAK.split(text or ""):
        lines = paragraph.split("\n")
        begins = [0] + [at for at in range(1, len(lines)) if marked(lines[at])[0]]
        found += ["\n".join(lines[a:b]) for a, b in zip(begins, [*begins[1:], len(lines)])]
    return [p for p in found if p.strip()] or [""]


def marked(paragraph: str) -> tuple[int, str]:
    """(kind of marker or 0, the paragraph without it)."""
    match = MARKER.match(paragraph)
    if match:
        name = (match["tag"] or match["box"] or match["name"]).lower()
        if name in NAMES:
            return NAMES[name], paragraph[match.end() :]
    return 0, paragraph


def observed(paragraph: str) -> list[int]:
    """A small number for each of FEATURES."""
    kind, rest = marked(paragraph)
    last = rest.rstrip()[-1:]
    return [
        kind,
        min(len(rest).bit_length(), SIZES - 1),
        min(rest.count("\n"), LINES - 1),
        1 if last == "?" else 2 if last in ".!" and last else 3 if last == ":" else 0,
    ]


def held_out():
    """Transcripts whose roles are not learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _runs(kind: pa.DataType):
    """Paragraphs in order, in runs of one transcript."""
    item = pa.struct([("turn", pa.int64()), ("paragraph", pa.int32()), ("text", pa.string())])

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        waiting, now, out = [], None, []

        def closed():
            nonlocal number
            number += 1
            return (now[0], (part << 32) + number, waiting)

        def taken():
            ids, seq, rows = zip(*out)
            return pa.record_batch(
                [
                    pa.array(ids, kind),
                    pa.array(seq, pa.int64()),
                    pa.array(rows, pa.list_(item)),
                ],
                names=["conv_id", "seq", "run"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "text"))
            for conv, turn, text in zip(*columns):
                for k, paragraph in enumerate(paragraphs(text)):
                    if now != (conv,) or len(waiting) == RUN:
                        if waiting:
                            out.append(closed())
                        waiting, now = [], (conv,)
                    waiting.append({"turn": turn, "paragraph": k, "text": paragraph})
                if len(out) >= 500:
                    yield taken()
                    out = []
        if waiting:
            out.append(closed())
        if out:
            yield taken()

    return run


def _examples(batches):
    """What is seen of the paragraphs of known turns."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")]
        rows = [
            (conv, turn, role, k, *observed(paragraph))
            for conv, turn, role, text in zip(*columns)
            for k, paragraph in enumerate(paragraphs(text))
        ]
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string()] + [pa.int32()] * 5
        names = ["conv_id", "turn", "role", "paragraph", "f0", "f1", "f2", "f3"]
        columns = zip(*rows) if rows else [[]] * 8
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


class Model:
    """Log probabilities of the states: opening a turn in each role, and going on with it."""

    def __init__(self, roles: list[str], starts, moves, seen):
        self.roles = roles
        n = len(roles)
        self.first = np.full(2 * n, -np.inf)
        self.first[:n] = np.log((starts + 0.5) / (starts + 0.5).sum())
        # moves[i, j]: from paragraphs of role i to an opening one of role j; moves[i, n]: goes on.
        shares = np.log((moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True))
        self.move = np.full((2 * n, 2 * n), -np.inf)
        for i in range(n):
            for state in (i, n + i):
                self.move[state, :n] = shares[i, :n]
                self.move[state, n + i] = shares[i, n]
        # What no example shows is still possible; of markers it is known what they mean.
        prior = [np.full(s.shape, 0.5) for s in seen]
        prior[0][:, 1:] = OTHER_MARKER
        self.kinds = [NAMES.get(role.lower(), 0) for role in roles]
        for state, kind in enumerate(self.kinds):
            if kind:
                prior[0][state, kind] = OWN_MARKER
        self.seen = [
            np.log((s + p) / (s + p).sum(axis=1, keepdims=True)) for s, p in zip(seen, prior)
        ]

    def emitted(self, run: list[dict]) -> np.ndarray:
        """(paragraph, state): how likely what is seen of it is."""
        features = np.array([observed(item["text"]) for item in run])
        return sum(seen.T[features[:, k]] for k, seen in enumerate(self.seen))

    def entered(self, emitted: np.ndarray) -> np.ndarray:
        """(state before, state at the end): the best score over a run."""
        best = self.move + emitted[0]
        for row in emitted[1:]:
            best = (best[:, :, None] + self.move[None]).max(axis=1) + row
        return best

    def decoded(self, emitted: np.ndarray, entry: np.ndarray | None, exit_: int | None):
        """The best states of a run, given the scores before it and the state at its end."""
        if entry is None:
            score = self.first + emitted[0]
        else:
            score = (entry[:, None] + self.move).max(axis=0) + emitted[0]
        back = []
        for row in emitted[1:]:
            moves = score[:, None] + self.move
            back.append(moves.argmax(axis=0))
            score = moves.max(axis=0) + row
        states = [int(score.argmax()) if exit_ is None else exit_]
        for row in reversed(back):
            states.append(int(row[states[-1]]))
        return states[::-1]


def learned(turns: DataFrame, most: int = MOST) -> Model | None:
    """The model, from at most about `most` transcripts."""
    known = turns.where("conv_id is not null and role is not null").where(~held_out())
    n = known.agg(F.approx_count_distinct("conv_id").alias("n")).head()["n"]
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "conv_id"), F.lit(1_000_000))
    sample = known.where(drawn * max(n, 1) < most * 1_000_000)
    kind = turns.schema["conv_id"].dataType.simpleString()
    seen = stored(
        sample.mapInArrow(
            _examples,
            f"conv_id {kind}, turn long, role string, paragraph int, f0 int, f1 int, f2 int, f3 int",
        ),
        "examples",
    )
    roles = sorted(row["role"] for row in seen.select("role").distinct().collect())
    if not roles:
        return None
    size, at = len(roles), {role: k for k, role in enumerate(roles)}
    tables = [np.zeros((2 * size, width)) for width in FEATURES]
    opens = (F.col("paragraph") == 0).alias("opens")
    for k, table in enumerate(tables):
        for row in seen.groupBy("role", opens, F.col(f"f{k}").alias("f")).count().collect():
            table[at[row["role"]] + size * (not row["opens"]), row["f"]] = row["count"]
    # Neighbours in a sample of bounded size.
    order = Window.partitionBy("conv_id").orderBy("turn", "paragraph", "role")
    moves, starts = np.zeros((size, size + 1)), np.zeros(size)
    pairs = seen.select(F.lag("role").over(order).alias("before"), "role", opens)
    for row in pairs.groupBy("before", "role", "opens").count().collect():
        if row["before"] is None:
            starts[at[row["role"]]] += row["count"]
        else:
            to = at[row["role"]] if row["opens"] else size
            moves[at[row["before"]], to] += row["count"]
    return Model(roles, starts, moves, tables)


def _summaries(model):
    def run(batches):
        for batch in batches:
            best = [
                model.entered(model.emitted(items)).tobytes()
                for items in batch.column("run").to_pylist()
            ]
            first = [
                (model.first + model.emitted(items[:1])[0]).tobytes()
                for items in batch.column("run").to_pylist()
            ]
            own = [
                model.entered(model.emitted(items[1:])).tobytes()
                if len(items) > 1
                else b""
                for items in batch.column("run").to_pylist()
            ]
            yield pa.record_batch(
                [batch.column("conv_id"), batch.column("seq")]
                + [pa.array(x, pa.binary()) for x in (best, first, own)],
                names=["conv_id", "seq", "best", "first", "own"],
            )

    return run


def _borders(batches):
    """For each run of a long transcript: scores before it, and its last state."""
    for batch in batches:
        out = []
        for runs in batch.column("runs").to_pylist():
            score, entries = None, []
            for item in runs:
                entries.append(score)
                if score is None:
                    score = np.frombuffer(item["first"])
                    if item["own"]:
                        own = np.frombuffer(item["own"]).reshape(len(score), -1)
                        score = (score[:, None] + own).max(axis=0)
                else:
                    best = np.frombuffer(item["best"]).reshape(len(score), -1)
                    score = (score[:, None] + best).max(axis=0)
            state = int(score.argmax())
            for item, entry in zip(reversed(runs), reversed(entries)):
                out.append((item["seq"], None if entry is None else entry.tobytes(), state))
                if entry is not None:
                    best = np.frombuffer(item["best"]).reshape(len(entry), -1)
                    state = int((entry + best[:, state]).argmax())
        columns = zip(*out) if out else [[]] * 3
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int32()))],
            names=["seq", "entry", "last"],
        )


def _rendered(model, kind: pa.DataType):
    def run(batches):
        known = model
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "run", "entry", "last"))
            for conv, items, entry, last in zip(*columns):
                if known is None:
                    states = [None] * len(items)
                else:
                    scores = None if entry is None else np.frombuffer(entry)
                    states = known.decoded(known.emitted(items), scores, last)
                for item, state in zip(items, states):
                    body, role, opens = item["text"], None, True
                    if state is not None:
                        role, opens = known.roles[state % len(known.roles)], state < len(known.roles)
                        kind_of, rest = marked(body)
                        if opens and kind_of and known.kinds[state] == kind_of:
                            body = rest
                    header = f"<|{role}|>\n" if opens and role else ""
                    out.append(
                        (conv, item["turn"], item["paragraph"], role, opens, f"{header}{body}\n")
                    )
            kinds = (kind, pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string())
            columns = zip(*out) if out else [[]] * 6
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["conv_id", "turn", "paragraph", "role_pred", "opens", "rendered"],
            )

    return run


def in_order(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, text) in this order, over all partitions."""
    # The start of a text orders rows as the text does, and bounds of ranges stay short.
    start = F.substring("text", 1, 64)
    return turns.repartitionByRange("conv_id", "turn", start).sortWithinPartitions(
        "conv_id", "turn", "text"
    )


def transcripts(turns: DataFrame, most: int = MOST) -> DataFrame:
    """(conv_id, turn, paragraph, role_pred, opens, rendered, held_out) of (conv_id, turn, role, text).

    The role is only learned from, never looked at for a prediction. The rendered paragraphs of a
    transcript, one after another, are its canonical form.
    """
    turns = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    spark = turns.sparkSession
    model = learned(turns, most)
    kind = turns.schema["conv_id"].dataType.simpleString()
    arrow = turns.limit(0).select("conv_id").toArrow().schema.field("conv_id").type
    runs = stored(
        in_order(turns.select("conv_id", "turn", "text"))
        .mapInArrow(
            _runs(arrow),
            f"conv_id {kind}, seq long, run array<struct<turn:bigint,paragraph:int,text:string>>",
        ),
        "runs",
    )
    several = runs.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    long = runs.join(several, runs["conv_id"].eqNullSafe(several["conv_id"]), "left_semi")
    if model is not None:
        borders = (
            long.mapInArrow(
                _summaries(model), f"conv_id {kind}, seq long, best binary, first binary, own binary"
            )
            .groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("seq", "best", "first", "own"))).alias("runs"))
            .mapInArrow(_borders, "seq long, entry binary, last int")
        )
    else:
        borders = spark.createDataFrame([], "seq long, entry binary, last int")
    return (
        runs.join(borders, "seq", "left")
        .mapInArrow(
            _rendered(model, arrow),
            f"conv_id {kind}, turn long, paragraph int, role_pred string, opens boolean, "
            "rendered string",
        )
        .withColumn("held_out", held_out())
    )
