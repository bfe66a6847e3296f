"""Cheapest repairs of conversations whose turns are out of order, doubled, empty or cut off.

A conversation is its rows by turn (null turns first; rows of one turn by role, then text). Each row has
at most one fault, the first of: blank (no visible character), duplicate (role and text seen earlier in
the conversation), truncated (the last visible character is none of `.!?`). A repair gives every row one
letter, and may insert turns:

    K  keep the row, for nothing                 R  give it the role user or assistant, for 3
    D  delete it, for 4                          I  insert an empty turn of user or assistant, for 3

Blank rows and duplicates have to be deleted; a truncated row that stays adds 3. The roles that result
are an optional system turn and then pairs of user and assistant, or nothing. Of the cheapest repairs
the one whose letters come first in ASCII order is taken.

1. Faults are found by joins: the first turn of each role and text of a conversation, and rows that are
   alike counted before they are dealt out.
2. All rows are put in order over all partitions. Runs of at most RUN rows of a conversation become a
   piece of its signature, a letter for the role and fault of each row; the pieces are joined to one
   signature for each conversation.
3. Distinct signatures are dealt out in the order of their reversed letters, so that those with a common
   end lie together: the nodes of the automaton are the common ends. A task walks over them with a stack
   that holds a node for each letter from the end; what a signature shares with the one before stays on
   the stack. A node has, for each state of the grammar, the cost to go and the first letter of the best
   audit, which goes on at the next node. These are worked out once for each node, for all conversations.
4. Each run is repaired by its part of the audit. Only the hash of a conversation needs its runs one
   after another: they stream through one task, a run at a time.

A hash cannot be taken in parts, so a conversation of any length is hashed by one task, with the memory
of one run. Its signature and its audit, a byte for each row, are single values.

Nulls in role and text count as one blank. A null conv_id is an id like any other. Gaps between turns
beyond the largest long count as that. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.scratch import stored

RUN = 512
RUN_CHARACTERS = 1_000_000
VISIBLE = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
LARGEST = (1 << 63) - 1

# States of the grammar: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# Which state a kept row leads to, by state and initial of its role.
KEPT = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
# Where a turn of user or assistant leads to that is put in, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Cost to go and first letter in each state after the last row.
END = ((0, INSERT + INSERT, INSERT, 0), ("", "I", "I", ""))
GONE = "x"


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of turns, damaged by crc32(`conv_id:turn`) % 20.

    0 drops a row, 1 empties its text, 2 takes `.!?` out of it, 3 repeats it, 4 makes it a user's.
    """
    kind = F.crc32(F.concat_ws(":", _text("conv_id"), _text("turn")).cast("binary")) % 20
    text = _text("text")
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_text("role")).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
        kind.alias("kind"),
    ).where("kind != 0").drop("kind")


def marked(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, copies) with whether each is blank, again or cut off.

    `copies` names the column that says how often each row of `turns` stands there.
    """
    rows = (
        turns.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            _text("role").alias("role"),
            _text("text").alias("text"),
            (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
    )
    content = F.sha2(
        F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    rows = rows.withColumn("content", content).withColumn("place", place)
    first = rows.groupBy("conv_id", "content").agg(F.min("place").alias("first"))
    first = first.withColumnsRenamed({"conv_id": "first_conv", "content": "first_content"})
    same = F.col("conv_id").eqNullSafe(F.col("first_conv"))
    met = rows.join(first, same & (F.col("content") == F.col("first_content")))
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    return met.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        (~F.col("text").rlike(VISIBLE)).alias("blank"),
        (F.col("place") > F.col("first")).alias("again"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )


def initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "o"


STATS = ["blank", "duplicate", "truncated", "illegal", "turns"]


class _Run:
    """Some rows of a conversation, one after another."""

    def __init__(self) -> None:
        self.piece: list[str] = []
        self.items: list[dict] = []
        self.stats = dict.fromkeys(STATS, 0)
        self.initials = [None, None]
        self.ends = [None, None]
        self.rows = self.characters = 0

    def add(self, turn, role, text, copies, blank, again, cut) -> None:
        self.rows += 1
        mark = role[:1]
        if self.initials[0] is None:
            self.initials[0] = mark
        elif self.initials[1] + mark not in LEGAL:
            self.stats["illegal"] += 1
        self.initials[1] = mark
        if copies > 1 and mark + mark not in LEGAL:
            self.stats["illegal"] += copies - 1
        if turn is not None:
            self.stats["turns"] += turn != self.ends[1]
            if self.ends[0] is None:
                self.ends[0] = turn
            self.ends[1] = turn
        if blank or again:
            self.stats["blank" if blank else "duplicate"] += copies
            self.piece.append(GONE * copies)
            return
        self.stats["truncated"] += cut
        self.stats["duplicate"] += copies - 1
        letter = initial(role)
        self.piece.append((letter.upper() if cut else letter) + GONE * (copies - 1))
        self.items.append({"role": role, "text": text})
        self.characters += len(text)


ITEM = pa.struct([("role", pa.string()), ("text", pa.string())])
RUN_FIELDS = (
    "seq long, piece string, items array<struct<role:string,text:string>>, blank long, "
    "duplicate long, truncated long, illegal long, turns long, first_initial string, "
    "last_initial string, first_turn long, last_turn long"
)


def _runs(kind: pa.DataType):
    """Rows in order, in runs of one conversation."""
    kinds = [pa.int64(), pa.string(), pa.list_(ITEM), *[pa.int64()] * 5]
    kinds += [pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = [field.split()[0] for field in RUN_FIELDS.split(", ")]

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        now, open_run, closed, held = None, _Run(), [], 0

        def close():
            nonlocal number, open_run, held
            if open_run.rows:
                number += 1
                held += open_run.characters
                closed.append(
                    (now[0], (part << 32) + number, "".join(open_run.piece), open_run.items)
                    + tuple(open_run.stats.values())
                    + (*open_run.initials, *open_run.ends)
                )
            open_run = _Run()

        def taken():
            nonlocal closed, held
            columns = list(zip(*closed))
            closed, held = [], 0
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, [kind, *kinds])], names=["conv_id", *names]
            )

        fields = ("turn", "role", "text", "copies", "blank", "again", "cut")
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", *fields)]
            for conv, *row in zip(*columns):
                if now != (conv,) or open_run.rows >= RUN or open_run.characters > RUN_CHARACTERS:
                    close()
                    now = (conv,)
                open_run.add(*row)
                if len(closed) >= 1000 or held > 4 * RUN_CHARACTERS:
                    yield taken()
        close()
        if closed:
            yield taken()

    return run


def in_runs(rows: DataFrame) -> DataFrame:
    """Runs of conversations, in order of seq, of the rows of :func:`marked`."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = rows.limit(0).select("conv_id").toArrow().schema.field("conv_id").type
    # The start of a text orders rows as the text does, and bounds of ranges stay short.
    start = F.substring("text", 1, 64)
    return (
        rows.repartitionByRange("conv_id", "turn", "role", start)
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_runs(arrow), f"conv_id {kind}, {RUN_FIELDS}")
    )


def signatures(runs: DataFrame) -> DataFrame:
    """A row for each conversation: counts, signature, and seq and length of its runs."""
    row = F.struct(
        "seq", "piece", "first_initial", "last_initial", "first_turn", "last_turn"
    )
    whole = runs.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(row)).alias("runs"),
        F.min("first_turn").alias("first_turn"),
        F.max("last_turn").alias("last_turn"),
        *[F.sum(name).alias(name) for name in STATS],
    )
    # What two neighbouring runs have between them.
    borders = F.transform(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))),
        lambda after, i: F.struct(
            F.concat(F.get("runs", i)["last_initial"], after["first_initial"]).alias("pair"),
            (F.get("runs", i)["last_turn"] == after["first_turn"]).alias("same"),
        ),
    )
    whole = whole.withColumn("borders", borders)
    more = F.size(F.filter("borders", lambda b: ~b["pair"].isin(*LEGAL)))
    twice = F.size(F.filter("borders", lambda b: b["same"]))
    wide = "decimal(38,0)"
    missing = (
        F.col("last_turn").cast(wide) - F.col("first_turn").cast(wide) + 1 - F.col("turns") + twice
    )
    gaps = F.least(F.coalesce(missing, F.lit(0).cast(wide)), F.lit(LARGEST).cast(wide))
    return whole.select(
        "conv_id",
        gaps.cast("long").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + more).alias("illegal"),
        F.array_join(F.transform("runs", lambda r: r["piece"]), "").alias("signature"),
        F.transform(
            "runs", lambda r: F.struct(r["seq"].alias("seq"), F.length(r["piece"]).alias("rows"))
        ).alias("runs"),
    )


@functools.cache
def _node(letter: str, below: tuple[int, ...]) -> tuple[int, tuple, tuple]:
    """(base, costs, letters) of the node that comes before one with these costs.

    Costs are those over the base, the least of them, so that few kinds of nodes exist.
    """
    cut = CUT if letter.isupper() else 0
    best = []
    for state in range(4):
        options = [(DELETE + below[state], "D")]
        if letter != GONE:
            to = KEPT[state].get(letter.lower())
            if to is not None:
                options.append((cut + below[to], "K"))
            options.append((REROLE + cut + below[NEXT[state]], "R"))
        best.append(min(options))
    # Inserting leads to another state before the same row, and never twice in the cheapest repair
    # but for the start and the state after system, which go by way of user.
    user = min(best[USER], (INSERT + best[ASSISTANT][0], "I"))
    assistant = min(best[ASSISTANT], (INSERT + best[USER][0], "I"))
    out = [min(best[state], (INSERT + user[0], "I")) for state in (NOTHING, SYSTEM)]
    out += [user, assistant]
    base = min(cost for cost, _ in out)
    return base, tuple(cost - base for cost, _ in out), tuple(first for _, first in out)


class Automaton:
    """Nodes for the ends of signatures, on a stack; met in the order of reversed signatures."""

    def __init__(self) -> None:
        self.end = ""
        base = min(END[0])
        self.nodes = [(base, tuple(cost - base for cost in END[0]), END[1])]
        self.made = 0

    def read(self, reverse: str) -> None:
        """Nodes for all ends of a signature; those of the one before stay where they agree."""
        shared = 0
        for a, b in zip(self.end, reverse):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        total, below, _ = self.nodes[-1]
        for letter in reverse[shared:]:
            base, below, letters = _node(letter, below)
            total += base
            self.nodes.append((total, below, letters))
            self.made += 1
        self.end = reverse

    def best(self) -> tuple[int, str]:
        """Cost and audit of the signature on the stack."""
        total, costs, _ = self.nodes[-1]
        audit, state, depth = [], NOTHING, len(self.end)
        while True:
            letter = self.nodes[depth][2][state]
            if not letter:
                return total + costs[NOTHING], "".join(audit)
            audit.append(letter)
            if letter == "I":
                state = NEXT[state]
                continue
            depth -= 1
            state = passed(state, letter, self.end[depth])


def passed(state: int, edit: str, letter: str) -> int:
    """The state after a row."""
    if edit == "K":
        return KEPT[state][letter.lower()]
    return NEXT[state] if edit == "R" else state


def _audited(batches):
    automaton = Automaton()
    for batch in batches:
        found = []
        for reverse in batch.column("reverse").to_pylist():
            automaton.read(reverse)
            found.append((reverse[::-1], *automaton.best()))
        columns = list(zip(*found)) if found else [[]] * 3
        kinds = (pa.string(), pa.int64(), pa.string())
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["signature", "cost", "audit"]
        )


def audits(signature_rows: DataFrame) -> DataFrame:
    """(signature, cost, audit) of the distinct signatures of a table."""
    reverse = signature_rows.select(F.reverse("signature").alias("reverse")).distinct()
    return (
        reverse.repartitionByRange(F.substring("reverse", 1, 64))
        .sortWithinPartitions("reverse")
        .mapInArrow(_audited, "signature string, cost long, audit string")
    )


def parts(signature: str, audit: str, lengths: list[int]):
    """For runs of a conversation: the state before each, and its part of the audit.

    Turns that are inserted after the last row belong to the last run.
    """
    at = row = 0
    state = NOTHING
    for number, length in enumerate(lengths):
        began, entry, upto = at, state, row + length
        last = number == len(lengths) - 1
        while at < len(audit) and (row < upto or last):
            edit = audit[at]
            if edit == "I":
                state = NEXT[state]
            else:
                state = passed(state, edit, signature[row])
                row += 1
            at += 1
        yield entry, audit[began:at]


def small(batches, rows: int = 500):
    """The batches in smaller ones; a row may hold a whole run."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _parts(batches):
    for batch in small(batches):
        rows = []
        names = ("conv_id", "signature", "audit", "runs")
        for conv, signature, audit, runs in zip(*(batch.column(c).to_pylist() for c in names)):
            found = parts(signature, audit, [run["rows"] for run in runs])
            rows += [(conv, run["seq"], *part) for run, part in zip(runs, found)]
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = (batch.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.string())
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", "seq", "state", "audit"],
        )


def edited(piece: str, items: list[dict], state: int, audit: str):
    """The turns of a run after its edits: (edit, role, text)."""
    row, kept = 0, iter(items)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield {"edit": edit, "role": ROLES[state], "text": ""}
            continue
        letter = piece[row]
        row += 1
        item = next(kept) if letter != GONE else None
        state = passed(state, edit, letter)
        if edit == "K":
            yield {"edit": edit, **item}
        elif edit == "R":
            yield {"edit": edit, "role": ROLES[state], "text": item["text"]}


TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _repaired(batches):
    """Runs, each after its part of the audit, to runs of repaired turns."""
    part = None
    for batch in small(batches):
        names = ("conv_id", "seq", "state", "audit", "piece", "items")
        out = []
        for conv, seq, state, audit, piece, items in zip(
            *(batch.column(c).to_pylist() for c in names)
        ):
            if piece is None:
                part = (state, audit)
            else:
                out.append((conv, seq, list(edited(piece, items, *part))))
        columns = list(zip(*out)) if out else [[]] * 3
        kinds = (batch.schema.field("conv_id").type, pa.int64(), pa.list_(TURN))
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "seq", "turns"]
        )


def _hashed(kind: pa.DataType):
    """One hash for each conversation, from its runs one after another."""

    def run(batches):
        now, digest, first, out = None, None, True, []

        def taken():
            columns = list(zip(*out))
            out.clear()
            return pa.record_batch(
                [pa.array(columns[0], kind), pa.array(columns[1], pa.string())],
                names=["conv_id", "repaired_sha256"],
            )

        for batch in small(batches):
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turns"))
            for conv, turns in zip(*columns):
                if now != (conv,):
                    if now is not None:
                        out.append((now[0], digest.hexdigest()))
                    now, digest, first = (conv,), hashlib.sha256(), True
                for turn in turns:
                    digest.update(f"{'' if first else chr(10)}{turn['role']}:{turn['text']}".encode())
                    first = False
            if len(out) > 10_000:
                yield taken()
        if now is not None:
            out.append((now[0], digest.hexdigest()))
            yield taken()

    return run


class Repairs(NamedTuple):
    """conversations: counts, cost and audit of each. turns: its runs of repaired turns, by seq."""

    conversations: DataFrame
    turns: DataFrame


def repairs(turns: DataFrame, copies: str | None = None) -> Repairs:
    """The cheapest repair of each conversation of (conv_id, turn, role, text)."""
    runs = stored(in_runs(stored(marked(turns, copies), "marked")), "runs")
    whole = stored(signatures(runs), "signatures")
    found = whole.join(audits(whole), "signature")
    conversations = stored(found, "audits")
    kind = turns.schema["conv_id"].dataType.simpleString()
    part = conversations.select("conv_id", "signature", "audit", "runs").mapInArrow(
        _parts, f"conv_id {kind}, seq long, state int, audit string"
    )
    both = part.unionByName(runs.select("conv_id", "seq", "piece", "items"), allowMissingColumns=True)
    repaired = (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", F.col("piece").isNotNull())
        .mapInArrow(
            _repaired,
            f"conv_id {kind}, seq long, turns array<struct<edit:string,role:string,text:string>>",
        )
    )
    return Repairs(conversations.drop("signature", "runs"), repaired)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digests(
    turns: DataFrame, ids: DataFrame | None = None, copies: str | None = None
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    `ids` names the conversations to return, those without any turn included; by default those of
    the turns.
    """
    done = repairs(turns, copies)
    kind = turns.schema["conv_id"].dataType.simpleString()
    arrow = turns.limit(0).select("conv_id").toArrow().schema.field("conv_id").type
    # In the order of the runs within each partition.
    hashes = done.turns.mapInArrow(_hashed(arrow), f"conv_id {kind}, repaired_sha256 string")
    hashes = hashes.withColumnRenamed("conv_id", "hashed_id")
    out = done.conversations.join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed_id")))
    if ids is not None:
        every = ids.select(F.col("conv_id").alias("every_id")).distinct()
        out = every.join(out, F.col("every_id").eqNullSafe(F.col("conv_id")), "left")
        out = out.drop("conv_id").withColumnRenamed("every_id", "conv_id")
    nothing = hashlib.sha256().hexdigest()
    return out.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
