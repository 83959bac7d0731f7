"""Operator 13: conversations repaired by the cheapest edits to a legal order of roles.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Each row may be kept, given
another role, or deleted, and empty rows may be inserted; the cheapest edits are a shortest path
through the lattice of (rows read, state of the pattern). It is found by a bidirectional Dijkstra
search: a forward and a reverse heap go by whole levels of cost until they have met and no crossing
of equal cost is left; of the paths over all crossings, the one with the least audit is walked.

Rows are ranged in their order and cut into blocks of 4096 places at most, so that a conversation of
any length is searched by many tasks: a block by itself, from each state that it may begin in to each
that it may end in. Of a conversation that lies in several blocks one task then sees a few numbers a
block, not its rows. Texts are shuffled once, by conversation, and stream past the edits in order:
a digest of a whole conversation can't be had in parts, but nothing of it is held in memory.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import in_order, landed, table

#: Places of the order in a block, as bits.
BLOCK_BITS = 12
#: Bits of a repaired row's place that count within its block.
PLACE_BITS = 16
#: Blocks of so few rows have their edits remembered, as many of them as REMEMBERED.
SHORT, REMEMBERED = 32, 1 << 15

# What edits cost, and the white space of a blank text.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK = " \t\n\x0b\f\r"

# States of the pattern: nothing yet, after s, after u, after a; it may end in END.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES, END = 4, (BEGIN, ASSISTANT)
#: Where the one role that may be written next leads, and its initial's role.
NEXT = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP = {("s", BEGIN): SYSTEM} | {("u", q): USER for q in (BEGIN, SYSTEM, ASSISTANT)} | {("a", USER): ASSISTANT}


def _edges(symbol: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, initial, next state) of what may be done with a row; symbols are s, u, a and o for other
    roles, capitals if the text is truncated, and x for rows that must go."""
    found = [(DELETE, "D", state)]
    if symbol != "x":
        more = TRUNCATED if symbol.isupper() else 0
        found.append((REROLE + more, "R", NEXT[state]))
        if (kept := KEEP.get((symbol.lower(), state))) is not None:
            found.append((more, "K", kept))
    return found


EDGES = {(x, q): _edges(x, q) for x in "suaoSUAOx" for q in range(STATES)}
BACK = {(x, q): [(w, p) for p in range(STATES) for w, _, to in EDGES[x, p] if to == q] for x in "suaoSUAOx" for q in range(STATES)}


class Lattice:
    """Nodes (rows read, state) as numbers; rows may be inserted before each row, at the end only if it is open."""

    def __init__(self, symbols: str, open_end: bool):
        self.symbols, self.last = symbols, len(symbols) if open_end else len(symbols) - 1

    def after(self, node: int) -> list[tuple[int, str, int]]:
        """(cost, initial, node) of all edits."""
        i, state = divmod(node, STATES)
        found = [(INSERT, "I", i * STATES + NEXT[state])] if i <= self.last else []
        if i < len(self.symbols):
            found += [(w, x, (i + 1) * STATES + to) for w, x, to in EDGES[self.symbols[i], state]]
        return found

    def before(self, node: int) -> list[tuple[int, int]]:
        """(cost, node) of all edits that lead here."""
        i, state = divmod(node, STATES)
        found = [(INSERT, i * STATES + p) for p, to in NEXT.items() if to == state] if i <= self.last else []
        if i:
            found += [(w, (i - 1) * STATES + p) for w, p in BACK[self.symbols[i - 1], state]]
        return found


def search(symbols: str, entry: int, exits: tuple[int, ...], open_end: bool) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits, the least audit of several; None if there are none."""
    return _remembered(symbols, entry, exits, open_end) if len(symbols) <= SHORT else _search(symbols, entry, exits, open_end)


def _search(symbols: str, entry: int, exits: tuple[int, ...], open_end: bool) -> tuple[int, str] | None:
    lattice, goals = Lattice(symbols, open_end), {len(symbols) * STATES + q for q in exits}
    cost: tuple[dict[int, int], dict[int, int]] = ({entry: 0}, dict.fromkeys(goals, 0))
    heaps = ([(0, entry)], [(0, x) for x in sorted(goals)])
    done: tuple[set[int], set[int]] = (set(), set())
    level = [-1.0, -1.0]
    best = 0 if entry in goals else math.inf
    # A side has settled all nodes up to its level, so once the levels come to one less than the
    # best cost, every node of every best path is settled on one side.
    while level[0] + level[1] < best - 1:
        side = 0 if len(heaps[0]) <= len(heaps[1]) else 1
        heap, mine, other, settled = heaps[side], cost[side], cost[1 - side], done[side]
        now = heap[0][0]
        while heap and heap[0][0] == now:
            node = heapq.heappop(heap)[1]
            if node in settled:
                continue
            settled.add(node)
            for edge in lattice.before(node) if side else lattice.after(node):
                to, new = edge[-1], now + edge[0]
                if new < mine.get(to, math.inf):
                    mine[to] = new
                    heapq.heappush(heap, (new, to))
                    if to in other:
                        best = min(best, new + other[to])
        level[side] = now if heap else math.inf
    if best is math.inf:
        return None
    return int(best), _least(lattice, entry, goals, cost, done, int(best))


_remembered = lru_cache(REMEMBERED)(_search)


def _least(lattice: Lattice, entry: int, goals: set[int], cost: tuple[dict, dict], done: tuple[set, set], best: int) -> str:
    """The least audit over all crossings of cost ``best``."""
    (ahead, behind), (front, rear) = cost, done

    def crosses(u: int, w: int, v: int) -> bool:
        return v not in front and v in rear and ahead[u] + w + behind[v] == best

    # Nodes of the front from which a crossing, or a goal, is reached at the best cost.
    good = {u for u in front if any(crosses(u, w, v) for w, _, v in lattice.after(u))}
    good |= {u for u in goals & front if ahead[u] == best}
    stack = list(good)
    while stack:
        v = stack.pop()
        for w, u in lattice.before(v):
            if u in front and u not in good and ahead[u] + w == ahead[v]:
                good.add(u)
                stack.append(u)
    audit, node = [], entry
    while node in front and not (node in goals and ahead[node] == best):
        ways = [(x, v) for w, x, v in lattice.after(node) if v in good and ahead[v] == ahead[node] + w or crosses(node, w, v)]
        letter, node = min(ways)
        audit.append(letter)
    while node not in goals:
        letter, node = min((x, v) for w, x, v in lattice.after(node) if v in rear and behind[v] + w == behind[node])
        audit.append(letter)
    return "".join(audit)


def walk(audit: str, classes: str, entry: int) -> Iterator[tuple[str, int, int]]:
    """(initial, row or -1, state after it) of each edit; ``classes`` are the initials s, u, a and o of the rows' roles."""
    state, row = entry, 0
    for letter in audit:
        if letter in "IR":
            state = NEXT[state]
        elif letter == "K":
            state = KEEP[classes[row], state]
        yield letter, -1 if letter == "I" else row, state
        row += letter != "I"


def _blocks(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's edits from each state at its begin to each at its end; counts of faults and illegal neighbours."""
    for record in records:
        ways, illegal, counts = [], [], {x: [] for x in "bdt"}
        columns = (record.column(x).to_pylist() for x in ("classes", "faults", "opens", "closes"))
        for classes, faults, opens, closes in zip(*columns, strict=True):
            symbols = "".join("x" if f in "bd" else c.upper() if f == "t" else c for c, f in zip(classes, faults, strict=True))
            found = []
            for entry in (BEGIN,) if opens else range(STATES):
                for exits in (END,) if closes else ((q,) for q in range(STATES)):
                    if (edits := search(symbols, entry, exits, closes)) is not None:
                        found.append({"entry": entry, "exit": exits[-1], "cost": edits[0], "audit": edits[1]})
            ways.append(found)
            illegal.append(sum(classes[i : i + 2] not in ("su", "ua", "au") for i in range(len(classes) - 1)))
            for x, n in counts.items():
                n.append(faults.count(x))
        kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        kept = [record.column(x) for x in ("conv", "block")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(ways, kind), *(pa.array(n, pa.int64()) for n in (illegal, *counts.values()))], names=[x.split()[0] for x in SEARCHED.split(", ")]
        )


WAY = "struct<entry:int,exit:int,cost:long,audit:string>"
SEARCHED = f"conv string, block long, ways array<{WAY}>, illegal long, blank long, duplicate long, truncated long"


#: Where a step stands among the rows of its key: before them, with the first of them, after them.
BEFORE, WITH, ROW, AFTER = range(4)
STEPS = "conv string, turn long, old string, digest binary, kind int, place long, role string, text string"


def _steps(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a block's edits write, each under the key (turn, role, digest) of a row beside it: kept rows,
    their role null if it stays, and inserted ones. A key that is kept is a row's of its own, for copies go."""
    for record in records:
        out: list[tuple] = []
        columns = (record.column(x).to_pylist() for x in ("conv", "block", "classes", "keys", "entry", "audit"))
        for conv, block, classes, keys, entry, audit in zip(*columns, strict=True):
            last = -1
            for k, (letter, row, state) in enumerate(walk(audit, classes, entry)):
                last = max(last, row)
                if letter == "D":
                    continue
                key, kind = keys[max(last, 0)], AFTER if letter == "I" else WITH
                if last < 0 and audit.lstrip("I")[:1] != "D":
                    kind = BEFORE
                place = (block << PLACE_BITS) + k
                out.append((conv, key["turn"], key["role"], key["digest"], kind, place, None if letter == "K" else ROLES[state], None))
        yield _batch(out, STEPS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[kind]) for x, (_, kind) in zip(columns, fields, strict=True)], names=[x for x, _ in fields])


REPAIRED = "conv string, place long, role string, text string"


def _written(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows from steps and rows in one order: a row is written if it follows the step that keeps it."""
    kept: tuple[int, str] | None = None
    for record in records:
        out = []
        for conv, old, kind, place, role, text in zip(*(record.column(x).to_pylist() for x in ("conv", "old", "kind", "place", "role", "text")), strict=True):
            if kind == WITH:
                kept = (place, role or old)
            elif kind != ROW:
                out.append((conv, place, role, ""))
            elif kept:
                out.append((conv, *kept, text))
                kept = None
        yield _batch(out, REPAIRED)


def _costs_on(group: pd.DataFrame) -> pd.DataFrame:
    """Of one conversation in several blocks: what it costs to go on from each state after each block."""
    out, onward = [], {END[-1]: 0}
    for block, ways in sorted(group.groupby("block"), key=lambda x: -x[0]):
        out += [(group["conv"].iloc[0], block, q, w) for q, w in onward.items()]
        new: dict[int, int] = {}
        for entry, leaves, cost in zip(ways["entry"], ways["exit"], ways["cost"], strict=True):
            if leaves in onward:
                new[entry] = min(new.get(entry, cost + onward[leaves]), cost + onward[leaves])
        onward = new
    return pd.DataFrame(out, columns=["conv", "block", "exit", "onward"])


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    """Of one conversation in several blocks: the state in which its edits enter each block."""
    out, state = [], BEGIN
    leads = {(b, q): to for b, q, to in zip(group["block"], group["entry"], group["exit"], strict=True)}
    for block in sorted(set(group["block"])):
        out.append((group["conv"].iloc[0], block, state))
        state = leads[block, state]
    return pd.DataFrame(out, columns=["conv", "block", "entry"])


def described(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with what the search needs of them: a key of the conversation
    that is never null, a digest of role and text, the class of the role, and what the text lacks."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("role", "text"))
    first, trimmed = F.substring(role, 1, 1), F.rtrim(text, F.lit(BLANK))
    return rows.select(
        F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"), role.alias("role"), text.alias("text"),
        F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("class"),
        F.when(trimmed == "", "b").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "t").otherwise(".").alias("lack"),
    )


def searched(rows: DataFrame) -> DataFrame:
    """Blocks of the rows of ``described`` with their rows' classes, faults and digests, their place among
    the blocks of their conversation, and their ``ways``; landed."""
    turns = landed(rows.select("conv", "turn", "digest", "role", "class", "lack", F.monotonically_increasing_id().alias("tie")), "turns")
    # Rows of one turn go by role and digest; rows alike in all are alike, and a number parts them.
    placed = in_order(turns, [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest"), F.col("tie")], "at")
    first = placed.groupBy("conv", "digest").agg(F.min("at").alias("first")).select("first", F.lit(True).alias("new"))
    marked = placed.join(first, placed["at"] == first["first"], "left")
    fault = F.when(F.col("lack") == "b", "b").when(F.col("new").isNull(), "d").otherwise(F.col("lack"))
    each = F.struct("at", "turn", F.col("class").alias("c"), fault.alias("f"), "role", "digest")
    lists = marked.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(each)).alias("r"))

    def each_of(name: str) -> Column:
        return F.transform("r", lambda x: x[name])

    turn_list = F.array_compact(each_of("turn"))
    blocks = lists.select(
        "conv", "block", F.concat_ws("", each_of("c")).alias("classes"), F.concat_ws("", each_of("f")).alias("faults"), 
        F.transform("r", lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), x["digest"].alias("digest"))).alias("keys"),
        F.array_min(turn_list).alias("low"), F.array_max(turn_list).alias("high"), F.size(F.array_distinct(turn_list)).cast("long").alias("turns"),
    )
    order = W.partitionBy("conv").orderBy("block")
    blocks = blocks.withColumns({
        "opens": F.lag("block").over(order).isNull(), "closes": F.lead("block").over(order).isNull(),
        # What neighbouring blocks share: a turn that goes on, and two roles that meet.
        "shared": F.coalesce((F.lag("high").over(order) == F.col("low")).cast("long"), F.lit(0)),
        "meet": F.concat(F.substring(F.lag("classes").over(order), -1, 1), F.substring("classes", 1, 1)),
    })
    blocks = landed(blocks, "blocks")
    found = blocks.select("conv", "block", "classes", "faults", "opens", "closes").mapInArrow(_blocks, SEARCHED)
    return landed(blocks.drop("faults").join(found, ["conv", "block"]), "searched")


def chosen(blocks: DataFrame) -> DataFrame:
    """(conv, block, entry, cost, audit): the way through each block that the cheapest edits of its conversation take; landed."""
    each = blocks.select("conv", "block", "opens", "closes", F.explode("ways").alias("way")).select("conv", "block", "opens", "closes", "way.*")
    whole = F.col("opens") & F.col("closes")
    alone = each.where(whole).select("conv", "block", "entry", "cost", "audit")
    several = landed(each.where(~whole).drop("opens", "closes"), "ways")
    onward = several.drop("audit").groupBy("conv").applyInPandas(_costs_on, "conv string, block long, exit int, onward long")
    # Audits of a block have no other as their beginning, for each ends with the block's last row; so
    # from each state the least total and then the least audit is right whatever follows.
    best = several.join(onward, ["conv", "block", "exit"]).groupBy("conv", "block", "entry").agg(
        F.min(F.struct((F.col("cost") + F.col("onward")).alias("total"), "audit", "exit", "cost")).alias("best")
    )
    best = landed(best.select("conv", "block", "entry", "best.*"), "best")
    path = best.select("conv", "block", "entry", "exit").groupBy("conv").applyInPandas(_chain, "conv string, block long, entry int")
    return landed(alone.unionByName(best.join(path, ["conv", "block", "entry"]).select("conv", "block", "entry", "cost", "audit")), "chosen")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation of ``rows`` (conv_id, turn, role, text), and the repaired rows.

    The first frame has a row for each conv_id: gaps, blank, duplicate, truncated, illegal, cost and
    audit. The second has the rows that the cheapest edits leave: conv_id, place (rising within the
    conversation), role and text.

    Rows go by turn, nulls first, then role and a digest of the text. A null role or text counts as
    one space, so such a text is blank; a null conv_id is a conversation of its own. Rows that repeat
    are duplicates of the first. Further columns, whatever their names, are left out; an empty table
    gives empty frames. Texts are looked at whole.
    """
    kind = rows.schema["conv_id"].dataType
    rows = described(rows.select("conv_id", "turn", "role", "text"))
    blocks = searched(rows)
    ways = chosen(blocks)
    conv_id = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")

    both = blocks.drop("ways", "keys").join(ways, ["conv", "block"])
    meets = F.coalesce((~F.col("meet").isin("su", "ua", "au")).cast("long"), F.lit(0))
    span = F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - F.col("shared"))
    reports = both.groupBy("conv").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"), *(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")),
        F.sum(F.col("illegal") + meets).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    steps = blocks.select("conv", "block", "classes", "keys").join(ways.drop("cost"), ["conv", "block"]).mapInArrow(_steps, STEPS)
    nothing = F.lit(None)
    texts = rows.select(
        "conv", "turn", F.col("role").alias("old"), "digest", F.lit(ROW).alias("kind"), nothing.cast("long").alias("place"), nothing.cast("string").alias("role"), "text"
    )
    # One shuffle of the texts: steps come to rows by their order.
    order = ["conv", F.asc_nulls_first("turn"), "old", "digest", "kind", "place"]
    left = steps.unionByName(texts).repartition("conv").sortWithinPartitions(*order).mapInArrow(_written, REPAIRED)
    return reports.select(conv_id, *reports.columns[1:]), left.select(conv_id, "place", "role", "text", "conv")


def _digests(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, its rows one after another in order. Nothing but the state of a hash is held."""
    conv = state = None
    for record in records:
        out = []
        for now, role, text in zip(*(record.column(x).to_pylist() for x in ("conv", "role", "text")), strict=True):
            if now == conv:
                state.update(b"\n")
            else:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state = now, hashlib.sha256()
            state.update(f"{role}:{text}".encode())
        yield _batch(out, DIGESTS)
    if state is not None:
        yield _batch([(conv, state.hexdigest())], DIGESTS)


DIGESTS = "conv string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """The registered query's damage: by a checksum of conv_id and turn rows are dropped, emptied, cut, repeated or given a role."""
    name = F.concat_ws(":", *(F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")))
    rows = rows.select("conv_id", "turn", *(F.coalesce(x, F.lit(" ")).alias(x) for x in ("role", "text")), (F.crc32(name) % 20).alias("fate"))
    rows = rows.where("fate <> 0").withColumns({
        "text": F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("fate") == 4, "user").otherwise(F.col("role")),
        "copy": F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    })
    return rows.drop("fate", "copy")


def digested(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the repaired rows that ``repair`` gives."""
    return repaired.select("conv", "role", "text").mapInArrow(_digests, DIGESTS)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    reports, repaired = repair(damaged(given))
    kind = given.schema["conv_id"].dataType
    conv = F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit(""))
    all_ids = given.select(conv.alias("conv")).distinct()
    found = all_ids.join(reports.withColumn("conv", conv).drop("conv_id"), "conv", "left").join(digested(repaired), "conv", "left")
    counts = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id"), *counts,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
