"""Repair of conversations: the cheapest edits that bring the roles of a conversation into order.

Roles are in order if their initials read `(s?(ua)+)?`. What a stretch of turns can become is a set
of items: "read so many turns, in this state of the pattern, having begun in that one". An edit
deduces one item from another; two neighbouring stretches deduce the item of both. Knuth's
generalisation of Dijkstra's search pops items by (cost, audit), where the audit is the text of the
edits' initials: both only grow with a deduction, and of two audits for the same item at the same
cost neither begins the other, so the order between them outlives any further edit. An item is
final when popped, and the search ends when its goals are.

A turn enters the search as one character, so a conversation's length is all that a search holds.
Long conversations are cut into stretches that are searched where they lie and deduced upwards in a
tree, 64 at a time; only the digest of the repaired text, one hash over all of it, streams through
a single task.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sent_if_small, write_table

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns whose numbers share a block are searched in one task.
BLOCK = 1024
#: Turns, and characters of text, of a stretch at most.
STRETCH, STRETCH_CHARS = 256, 4 << 20
#: Stretches deduced into one at a time.
FAN = 64

# the pattern's states: nothing read, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
#: What an inserted or renamed turn becomes in each state.
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: Pairs of states between which a stretch can lead: any, but never back from u and a.
SPANS = [(q, r) for q in range(4) for r in range(4) if r >= min(q, USER)]
WHOLE = [SPANS.index((START, START)), SPANS.index((START, ASSISTANT))]
LEGAL = {"su", "ua", "au"}

Weight = tuple[int, str]


def lightest(axioms: Iterable[tuple], deduced: Callable[[tuple], Iterable[tuple[tuple, int, str]]], goals: set) -> dict[tuple, Weight]:
    """The least (cost, audit) of each item, as far as it takes to make all `goals` final.

    `deduced` gives the items that follow from one that is final, with what the step adds to its
    cost and audit. Goals that no deduction reaches have no entry.
    """
    agenda: list[tuple[int, str, tuple]] = [(0, "", item) for item in axioms]
    heapq.heapify(agenda)
    final: dict[tuple, Weight] = {}
    left = len(goals)
    while agenda and left:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        left -= item in goals
        for conclusion, more, edit in deduced(item):
            if conclusion not in final:
                heapq.heappush(agenda, (cost + more, audit + edit, conclusion))
    return final


def _spans(length: int, deduced) -> list[Weight | None]:
    """Weights of SPANS over `length` steps, from items (state at the start, steps read, state)."""
    goals = {(q, length, r) for q, r in SPANS}
    final = lightest([(q, 0, q) for q in range(4)], deduced, goals)
    return [final.get((q, length, r)) for q, r in SPANS]


def search(turns: str) -> list[Weight | None]:
    """Weights of SPANS over turns: each the initial s, u, a or o of its role, upper case if truncated, x if it must go."""

    def deduced(item):
        begun, at, state = item
        wanted = WANTED[state]
        yield (begun, at, NEXT[state, wanted]), INSERT, "I"
        if at == len(turns):
            return
        yield (begun, at + 1, state), DELETE, "D"
        turn = turns[at]
        if turn == "x":
            return
        initial, more = turn.lower(), TRUNCATED if turn.isupper() else 0
        if (state, initial) in NEXT:
            yield (begun, at + 1, NEXT[state, initial]), more, "K"
        if initial != wanted:
            yield (begun, at + 1, NEXT[state, wanted]), REROLE + more, "R"

    return _spans(len(turns), deduced)


@lru_cache(maxsize=50_000)
def _short_search(turns: str) -> tuple[Weight | None, ...]:
    return tuple(search(turns))


def joined(stretches: list[list[Weight | None]]) -> list[Weight | None]:
    """Weights of SPANS over neighbouring stretches: an item and the next stretch's deduce the item of both."""

    def deduced(item):
        begun, at, state = item
        if at < len(stretches):
            for (q, r), weight in zip(SPANS, stretches[at], strict=True):
                if q == state and weight is not None:
                    yield (begun, at + 1, r), *weight

    return _spans(len(stretches), deduced)


def best(weights) -> Weight:
    """The cheapest repair of a whole conversation."""
    return min(w for w in (weights[k] for k in WHOLE) if w is not None)


def applied(audit: str, turns: Iterable[tuple[str, str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that a repair leaves; `turns` are (role, text, ...) in order."""
    turns, state = iter(turns), START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(turns)[:2]
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else WANTED[state]
        state = NEXT[state, initial]
        yield edit, role if edit == "K" else ROLES[initial], text


def _line(first: bool, role: str, text: str) -> bytes:
    return f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass")


def _digest(lines: Iterable[tuple[str, str, str]]) -> str:
    total, first = hashlib.sha256(), True
    for _, role, text in lines:
        total.update(_line(first, role, text))
        first = False
    return total.hexdigest()


EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with conv_id, turn, role and text after faults are put in, by crc32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 takes . ! ? out of it, 3 repeats the row, 4 makes its
    role user. A null in any of the four columns counts as one space, but a null turn stays null as
    the place of its row. `n` tells how often a row stands.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("kind <> 0").select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Rows that agree as one, with `n`, `block` and `lead`: whether no earlier row has this role and text.

    Whole rows are counted before they are shuffled, and only texts that stand under several turns
    of a conversation are looked up, so neither a row nor a text that is repeated very often
    gathers rows in one task.
    """
    alike = write_table(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")), "turns")
    place = F.struct(F.col("turn").isNotNull(), "turn")
    said = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    spread = (
        alike.groupBy("conv_id", said.alias("said"))
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
        .select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), F.col("first.turn").alias("_first"), F.lit(True).alias("_spread"))
    )
    spread = sent_if_small(write_table(spread, "spread"))
    found = alike.join(spread, alike.conv_id.eqNullSafe(spread._conv) & (said == spread._said), "left")
    return found.select(
        "conv_id", F.floor(F.col("turn") / BLOCK).alias("block"), "turn", "role", "text", "n",
        (F.col("_spread").isNull() | F.col("turn").eqNullSafe(F.col("_first"))).alias("lead"),
    )


_FACTS = [
    ("turns_from", pa.int64()), ("turns_to", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("initial_from", pa.string()), ("initial_to", pa.string()),
]
_SPAN_TYPES = "costs array<long>, audits array<string>, digest string"
_SQL_FACTS = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in _FACTS)


@dataclass
class _Facts:
    """What is counted of a stretch; add() appends the next one."""

    turns_from: int | None = None
    turns_to: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    initial_from: str | None = None
    initial_to: str | None = None

    def add(self, other: _Facts) -> None:
        if other.initial_from is None:
            return
        if self.initial_from is None:
            self.initial_from = other.initial_from
        else:
            self.illegal += self.initial_to + other.initial_from not in LEGAL
        self.initial_to = other.initial_to
        if other.turns_from is not None:
            self.turns += other.turns - (other.turns_from == self.turns_to)
            self.turns_from = other.turns_from if self.turns_from is None else self.turns_from
            self.turns_to = other.turns_to
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))


def read_turn(turn: int | None, role: str, text: str, n: int, lead: bool) -> tuple[str, _Facts]:
    """A row's characters for the search, one for each time that it stands, and what is counted of it."""
    initial, said = role[:1], text.rstrip(BLANKS)
    facts = _Facts(turn, turn, int(turn is not None), initial_from=initial, initial_to=initial)
    facts.illegal = (n - 1) * (initial + initial not in LEGAL)
    if not said:
        facts.blank = n
        return "x" * n, facts
    facts.duplicate = n - lead
    if not lead:
        return "x" * n, facts
    facts.truncated = int(said[-1] not in ENDS)
    kind = initial if initial in ("s", "u", "a") else "o"
    return (kind.upper() if facts.truncated else kind) + "x" * (n - 1), facts


@dataclass
class _Stretch:
    conv_id: object
    block: int | None
    part: int
    facts: _Facts = field(default_factory=_Facts)
    turns: list[str] = field(default_factory=list)
    texts: list[tuple[str, str]] = field(default_factory=list)
    held: int = 0

    def row(self, alone: bool) -> dict:
        """The stretch's row, with the digest of what a repair leaves if it is all of its block."""
        turns = "".join(self.turns)
        weights = _short_search(turns) if len(turns) <= 32 else search(turns)
        digest = None
        if alone and not self.part:
            digest = _digest(applied(best(weights)[1], self.texts))
        return _row(self.conv_id, self.block, self.part, self.facts, weights, digest)


def _row(conv_id, block, part, facts: _Facts, weights, digest) -> dict:
    spans = {"costs": [w and w[0] for w in weights], "audits": [w and w[1] for w in weights], "digest": digest}
    return {"conv_id": conv_id, "block": block, "part": part} | vars(facts) | spans


def _schema(conv_type: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("conv_id", conv_type), ("block", pa.int64()), ("part", pa.int64()), *_FACTS,
        ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("digest", pa.string()),
    ])


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of stretches from sorted rows (conv_id, block, turn, role, text, n, lead)."""
    out: list[dict] = []
    now: _Stretch | None = None
    conv_type = pa.int64()

    def flushed() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_pylist(out, schema=_schema(conv_type))
        out.clear()
        return rows

    for batch in batches:
        conv_type = batch.schema.field("conv_id").type
        for conv_id, block, turn, role, text, n, lead in _records([batch]):
            if now is None or (now.conv_id, now.block) != (conv_id, block):
                if now is not None:
                    out.append(now.row(alone=True))
                now = _Stretch(conv_id, block, 0)
            first = lead
            while n:
                room = STRETCH - sum(map(len, now.turns)) if now.held < STRETCH_CHARS else 0
                if room <= 0:
                    out.append(now.row(alone=False))
                    now = _Stretch(conv_id, block, now.part + 1)
                    continue
                some = min(n, room)
                kinds, facts = read_turn(turn, role, text, some, first)
                now.turns.append(kinds)
                # what must go needs no text
                now.texts.extend((role, text if kind != "x" else "") for kind in kinds)
                now.held += len(text) if kinds[0] != "x" else 0
                now.facts.add(facts)
                n, first = n - some, False
            if len(out) >= 1000:
                yield flushed()
    if now is not None:
        out.append(now.row(alone=True))
    if out:
        yield flushed()


def _merged(table: pa.Table) -> pa.Table:
    """One row from the rows of neighbouring stretches."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["block"] is not None, r["block"], r["part"]))
    facts = _Facts()
    for r in rows:
        facts.add(_Facts(**{name: r[name] for name, _ in _FACTS}))
    weights = joined([[None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"], strict=True)] for r in rows])
    row = _row(rows[0]["conv_id"], rows[0]["above"], rows[0]["part_above"], facts, weights, None)
    return pa.Table.from_pylist([row], schema=_schema(table.schema.field("conv_id").type))


def _as_one(stretches: DataFrame) -> DataFrame:
    """Rows of the same kind, one for each conversation: a reduction tree over blocks and parts of 64 neighbours each."""
    schema = f"conv_id {dict(stretches.dtypes)['conv_id']}, block long, part long, {_SQL_FACTS}, {_SPAN_TYPES}"

    def level(rows: DataFrame, above: Column, part_above: Column) -> DataFrame:
        named = rows.withColumns({"above": above, "part_above": part_above})
        merged = named.groupBy("conv_id", "above", "part_above").applyInArrow(_merged, schema)
        return write_table(merged, "stretches")

    rows, part, block = stretches, F.col("part"), F.col("block")
    while (rows.agg(F.max("part")).first()[0] or 0) > 0:
        rows = level(rows, block, F.floor(part / FAN))
    while rows.groupBy("conv_id").count().agg(F.max("count")).first()[0] > FAN:
        # a null block stays one of its own until the last step
        rows = level(rows, F.floor(block / FAN), part)
    return level(rows, F.lit(None).cast("long"), part)


def _best(name: str) -> Column:
    """`name` (costs or audits) of the cheaper of the two ways to end, ties by audit."""
    (empty, full), costs, audits = WHOLE, F.col("costs"), F.col("audits")
    better = costs[full].isNull() | (costs[empty] < costs[full]) | ((costs[empty] == costs[full]) & (audits[empty] < audits[full]))
    return F.when(better, F.col(name)[empty]).otherwise(F.col(name)[full])


def _in_order(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, conversation by conversation; sorts spill to disk."""
    no = {"turn": "long", "role": "string", "text": "string", "n": "long", "lead": "boolean"}
    heads = plans.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in no.items()], "audit")
    kept = rows.select("conv_id", F.lit(1).alias("kind"), *no, F.lit(None).cast("string").alias("audit"))
    return heads.unionByName(kept).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str, str]]]]:
    """(conv_id, its turns after the repair) from rows in the order of _in_order()."""
    records = _records(batches)
    head = next(records, None)
    while head is not None:
        conv_id, audit, following = head[0], head[-1], []

        def turns(following: list = following) -> Iterator[tuple[str, str]]:
            for record in records:
                if record[1] == 0:
                    following.append(record)
                    return
                for _ in range(record[5]):
                    yield record[3], record[4]

        rest = turns()
        yield conv_id, applied(audit, rest)
        for _ in rest:  # rows that are left: none, but for a reader that stopped early
            pass
        head = following[0] if following else None


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_type: list[pa.DataType] = []

    def watched() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv_type[:] = [batch.schema.field("conv_id").type]
            yield batch

    for conv_id, lines in _conversations(watched()):
        row = {"conv_id": conv_id, "digest": _digest(lines)}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("conv_id", conv_type[0]), ("digest", pa.string())]))


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_type: list[pa.DataType] = []

    def watched() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv_type[:] = [batch.schema.field("conv_id").type]
            yield batch

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        kinds = [("conv_id", conv_type[0]), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    out: list[dict] = []
    for conv_id, lines in _conversations(watched()):
        for place, (edit, role, text) in enumerate(lines):
            out.append({"conv_id": conv_id, "place": place, "edit": edit, "role": role, "text": text})
            if len(out) >= 1000:
                yield batch_of(out)
                out = []
    if out:
        yield batch_of(out)


def _plans(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Rows with their marks, each conversation's facts and audit (digest null if it is long), and ids of the long ones."""
    marked = write_table(_marked(rows), "marked")
    conv_type = dict(marked.dtypes)["conv_id"]
    dealt = marked.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    schema = f"conv_id {conv_type}, block long, part long, {_SQL_FACTS}, {_SPAN_TYPES}"
    stretches = write_table(dealt.mapInArrow(_searched, schema), "stretches")
    many = write_table(stretches.groupBy("conv_id").count().where("count > 1").select(F.col("conv_id").alias("_conv")), "many")
    if many.isEmpty():
        whole, many = stretches, None
    else:
        long = stretches.conv_id.eqNullSafe(many._conv)
        whole = stretches.join(many, long, "left_anti").unionByName(_as_one(stretches.join(many, long, "left_semi")))
    counted = ["turns_from", "turns_to", "turns", "blank", "duplicate", "truncated", "illegal", "digest"]
    return marked, whole.select("conv_id", *counted, _best("costs").alias("cost"), _best("audits").alias("audit")), many


def repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` hold conv_id, turn, role, text and how often a row stands (`n`); other columns are not
    read. A conversation's rows are in order of turn (null first), then role, then text, which
    settles rows that share a turn. A null conv_id is a conversation of its own. A role whose
    initial is not s, u or a (an empty one too) can only be renamed or deleted. An empty table
    gives no row.

    Null roles or texts must have been replaced, as damaged() does.
    """
    marked, plans, many = _plans(rows)
    if many is not None:
        plans = write_table(plans, "plans")
        of = marked.join(many, marked.conv_id.eqNullSafe(many._conv), "left_semi")
        heads = plans.join(many, plans.conv_id.eqNullSafe(many._conv), "left_semi")
        conv_type = dict(plans.dtypes)["conv_id"]
        streamed = _in_order(of, heads).mapInArrow(_hashed, f"conv_id {conv_type}, digest string")
        late = streamed.select(F.col("conv_id").alias("_late"), F.col("digest").alias("_digest"))
        plans = plans.join(late, plans.conv_id.eqNullSafe(late._late), "left").withColumn("digest", F.coalesce("_digest", "digest"))
    gaps = F.coalesce(F.col("turns_to") - F.col("turns_from") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return plans.select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("digest").alias("repaired_sha256")
    )


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), edit (K, R or I), role, text."""
    marked, plans, _ = _plans(rows)
    conv_type = dict(marked.dtypes)["conv_id"]
    return _in_order(marked, plans).mapInArrow(_written, f"conv_id {conv_type}, place long, edit string, role string, text string")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """repairs() of damaged() rows, one row for every conv_id of `conversations`.

    A conversation of which no row is left has zeros, an empty audit and the digest of empty text.
    """
    found = repairs(damaged(conversations))
    every = conversations.select(F.col("conv_id").alias("_every")).distinct()
    joined_rows = every.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined_rows.select(
        F.col("_every").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_DIGEST)).alias("repaired_sha256"),
    )
