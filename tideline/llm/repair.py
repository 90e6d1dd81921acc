"""Repair of conversations: a Re-Pair grammar over faults, one min-plus matrix with audit ropes per rule."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import CachedWords, kept, to_arrow
from tideline.operators.groups import stored

# Initials of the roles that count, and costs of the edits.
INITIALS = "sua"
REROLE, DELETE, INSERT, TRUNCATED_STAYS = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
# A symbol is four times the role's number (3 for any other role) plus the fault's.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
SYMBOLS = 16
# Rows of a block; blocks are compressed and evaluated apart.
BLOCK_ROWS = 4_096
# Rounds of the grammar and rules of a round; with fewer rules blocks only stay longer.
ROUNDS, ROUND_RULES = 8, 48
# States: nothing yet, after s, after u, after a. A repaired conversation is empty or ends after a.
STATES, START, ENDS = 4, 0, (0, 3)
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

Rope = str | tuple
Entry = tuple[int, Rope]


# ---- ropes and matrices -------------------------------------------------------------


def size(rope: Rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[0]


def joined(a: Rope, b: Rope) -> Rope:
    if not size(a) or not size(b):
        return a if size(a) else b
    return (size(a) + size(b), a, b)


def flat(rope: Rope) -> str:
    parts, left = [], [rope]
    while left:
        x = left.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            left += [x[2], x[1]]
    return "".join(parts)


def before(a: Rope, b: Rope) -> bool:
    """Whether a's text comes before b's; shared parts are passed over unread."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if not isinstance(x, str) and (isinstance(y, str) or x[0] >= y[0]):
            left += [x[2], x[1]]
            right.append(y)
        elif not isinstance(y, str):
            left.append(x)
            right += [y[2], y[1]]
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            left += [x[n:]] if len(x) > n else []
            right += [y[n:]] if len(y) > n else []
    return bool(right) and not left


def better(a: Entry | None, b: Entry | None) -> Entry | None:
    """The cheaper of two ways, of equals the one whose audit comes first."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if before(b[1], a[1]) else a


def times(a: list, b: list) -> list:
    """Min-plus product of two matrices (or of a row and a matrix), None where there is no way.

    Keeping one way per cell is enough: no audit of one cell is the beginning of another of equal
    cost, since the longer one would have inserted, and paid for, the rest.
    """
    made = []
    for start in range(0, len(a), STATES):
        for end in range(STATES):
            best = None
            for mid in range(STATES):
                x, y = a[start + mid], b[mid * STATES + end]
                if x is not None and y is not None and (best is None or x[0] + y[0] <= best[0]):
                    best = better(best, (x[0] + y[0], joined(x[1], y[1])))
            made.append(best)
    return made


def insertions() -> list:
    """No, one or two insertions; a third would come back to a state already paid for."""
    made: list = [None] * (STATES * STATES)
    for start in range(STATES):
        made[start * STATES + start] = (0, "")
        first = STEPS["u"].get(start, STEPS["a"].get(start))
        made[start * STATES + first] = better(made[start * STATES + first], (INSERT, "I"))
        second = STEPS["u"].get(first, STEPS["a"].get(first))
        made[start * STATES + second] = better(made[start * STATES + second], (2 * INSERT, "II"))
    return made


def row_edits(symbol: int) -> list:
    """Ways of keeping, reroling or deleting one row, from each state to each."""
    role, fault = divmod(symbol, 4)
    made: list = [None] * (STATES * STATES)
    for start in range(STATES):
        made[start * STATES + start] = (DELETE, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        more = TRUNCATED_STAYS if fault == TRUNCATED else 0
        for edit, initial, cost in [("K", INITIALS[role : role + 1], 0), ("R", "u", REROLE), ("R", "a", REROLE)]:
            end = STEPS.get(initial, {}).get(start)
            if end is not None:
                cell = start * STATES + end
                made[cell] = better(made[cell], (cost + more, edit))
    return made


class Facts:
    """What is known of a stretch of rows: counts, first and last role, and its matrix."""

    __slots__ = ("blank", "duplicate", "truncated", "illegal", "first", "last", "ways")

    def __init__(self, blank, duplicate, truncated, illegal, first, last, ways):
        self.blank, self.duplicate, self.truncated, self.illegal = blank, duplicate, truncated, illegal
        self.first, self.last, self.ways = first, last, ways

    def then(self, other: Facts) -> Facts:
        return Facts(
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + unlawful(self.last, other.first),
            self.first,
            other.last,
            times(self.ways, other.ways),
        )


def unlawful(role: int, following: int) -> bool:
    return (INITIALS[role : role + 1] + INITIALS[following : following + 1]) not in ("su", "ua", "au")


def symbol_facts(symbol: int) -> Facts:
    role, fault = divmod(symbol, 4)
    ways = times(insertions(), row_edits(symbol))
    return Facts(int(fault == BLANK), int(fault == DUPLICATE), int(fault == TRUNCATED), 0, role, role, ways)


# ---- the grammar --------------------------------------------------------------------

Rules = list[list[tuple[int, int, int]]]


def compressed(blocks: list[bytes], rules: Rules) -> np.ndarray:
    """The blocks in symbols of the grammar, a -1 after each.

    In a round no symbol is the left one of a rule and the right one of another, so all its rules
    are applied at once; only a rule of a symbol and itself has to be counted along.
    """
    found = np.frombuffer(b"".join(block + b"\xff" for block in blocks), dtype=np.uint8).astype(np.int32)
    found[found == 255] = -1
    for chosen in rules if len(found) else []:
        wide = max(symbol for _, _, symbol in chosen) + 2
        order = np.sort(np.array([a * wide + b for a, b, _ in chosen], dtype=np.int64))
        made = {a * wide + b: symbol for a, b, symbol in chosen}
        symbols = np.array([made[code] for code in order.tolist()], dtype=np.int32)
        codes = np.where(found[:-1] >= 0, found[:-1].astype(np.int64) * wide + found[1:], -1)
        codes[found[1:] < 0] = -1
        at = np.minimum(np.searchsorted(order, codes), len(order) - 1)
        hit = order[at] == codes
        place = np.arange(len(hit))
        begins = hit & ~np.append(False, hit[:-1])
        hit &= (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
        found[:-1][hit] = symbols[at[hit]]
        found = found[~np.append(False, hit)]
    return found


def learn(blocks: DataFrame) -> Rules:
    """Rules for the most frequent neighbours among all different blocks, in rounds.

    Each round counts pairs on the executors, and takes from the most frequent ones those that do
    not compete for a symbol. It ends when no pair occurs twice. The driver gets at most
    ``8 * ROUND_RULES`` pairs a round.
    """
    different = stored(blocks.select("symbols").distinct())
    rules: Rules = []
    while len(rules) < ROUNDS:
        known = [list(chosen) for chosen in rules]

        def pairs(batches: Iterator[pa.RecordBatch], known=known):
            for batch in batches:
                found = compressed(batch.column(0).to_pylist(), known)
                inner = (found[:-1] >= 0) & (found[1:] >= 0)
                codes, counts = np.unique(found[:-1][inner].astype(np.int64) << 32 | found[1:][inner], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["pair", "n"])

        seen = different.mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        left, right, chosen = set(), set(), []
        number = SYMBOLS + sum(map(len, rules))
        for row in seen.orderBy(F.col("n").desc(), "pair").limit(8 * ROUND_RULES).collect():
            a, b = row["pair"] >> 32, row["pair"] & 0xFFFFFFFF
            if a in right or b in left or len(chosen) == ROUND_RULES:
                continue
            left.add(a)
            right.add(b)
            chosen.append((a, b, number + len(chosen)))
        if not chosen:
            break
        rules.append(chosen)
    return rules


def rule_facts(rules: Rules) -> list[Facts]:
    """Facts of all symbols, bottom-up: a rule's are its two symbols' put together."""
    facts = [symbol_facts(symbol) for symbol in range(SYMBOLS)]
    for chosen in rules:
        for a, b, _ in chosen:
            facts.append(facts[a].then(facts[b]))
    return facts


def folded(parts: list[Facts]) -> Facts:
    """The product of many, by halves."""
    while len(parts) > 1:
        odd = [parts[-1]] if len(parts) % 2 else []
        parts = [a.then(b) for a, b in zip(parts[::2], parts[1::2])] + odd
    return parts[0]


# ---- rows, blocks, conversations ----------------------------------------------------


def prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, NULL roles and texts as one space, and a digest of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.md5(text.cast("binary")).alias("_ll_key"))


def symbol() -> Column:
    """Role and fault of a row by itself."""
    ending = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    fault = F.when(ending == "", BLANK).when(ending.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    role = F.lit(len(INITIALS))
    for number, initial in enumerate(INITIALS):
        role = F.when(F.substring("role", 1, 1) == initial, number).otherwise(role)
    return (role * 4 + fault).cast("int")


ORDER = ["conv_id", "turn", "role", "_ll_key"]
BLOCK = ["_ll_turn", "_ll_role", "_ll_text", "_ll_at"]


def blocks_of(rows: DataFrame) -> DataFrame:
    """The symbols of each conversation in order, in blocks; ``BLOCK`` puts the blocks in order.

    Rows are dealt by ranges of conversation and turn, so a conversation of any size is spread; the
    texts stay behind. A row is a duplicate if its role and text occur in an earlier turn, or
    just before it in the same turn: equal rows of a turn stand together.
    """
    light = prepared(rows).select("conv_id", "turn", "role", "_ll_key", symbol().alias("_ll_symbol"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    said = light.groupBy("conv_id", "role", "_ll_key").agg(F.count(F.lit(1)).alias("_ll_n"), F.min(turn).alias("_ll_first"))
    said = said.filter("_ll_n > 1").select(F.col("conv_id").alias("_ll_c"), F.col("role").alias("_ll_r"), F.col("_ll_key").alias("_ll_k"), "_ll_first")
    same = F.col("conv_id").eqNullSafe(F.col("_ll_c")) & (F.col("role") == F.col("_ll_r")) & (F.col("_ll_key") == F.col("_ll_k"))
    later = F.coalesce(turn > F.col("_ll_first"), F.lit(False))
    marked = light.join(said, same, "left").select(*light.columns, later.alias("_ll_later"))
    dealt = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    kinds = {field.name: field.dataType for field in marked.schema}
    schema = T.StructType(
        [
            T.StructField("conv_id", kinds["conv_id"]),
            T.StructField("_ll_turn", kinds["turn"]),
            T.StructField("_ll_role", T.StringType()),
            T.StructField("_ll_text", T.StringType()),
            T.StructField("_ll_at", T.LongType()),
            T.StructField("symbols", T.BinaryType()),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]):
        arrow = to_arrow(schema)
        made, held, symbols, last, at = [], None, bytearray(), None, 0
        for batch in batches:
            for *row, code, again in zip(*[column.to_pylist() for column in batch.columns]):
                if code & 3 < BLANK and (again or row == last):
                    code |= DUPLICATE
                if held is None or row[0] != held[0] or len(symbols) == BLOCK_ROWS:
                    if held is not None:
                        made.append((*held, bytes(symbols)))
                    held, symbols = (*row, at), bytearray()
                symbols.append(code)
                last, at = row, at + 1
            if len(made) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), arrow.types)], schema=arrow)
                made = []
        if held is not None:
            made.append((*held, bytes(symbols)))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), arrow.types)], schema=arrow)

    return stored(dealt.mapInArrow(pack, schema))


FACTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "first", "last")]
    + [T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))]
)
REPORT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
    + [T.StructField("audit", T.StringType())]
)


def block_facts(blocks: DataFrame, rules: Rules) -> DataFrame:
    """Each block evaluated by the grammar; equal short blocks of a worker once."""
    name = ("repair", uuid.uuid4().hex)
    given = [name for name in blocks.columns if name != "symbols"]
    schema = T.StructType([blocks.schema[name] for name in given] + FACTS.fields)

    def cache() -> CachedWords:
        facts = rule_facts(rules)

        def compute(symbols: bytes) -> tuple:
            found = folded([facts[i] for i in compressed([symbols], rules)[:-1].tolist()])
            costs = [w and w[0] for w in found.ways]
            return (found.blank, found.duplicate, found.truncated, found.illegal, found.first, found.last, costs, [w and flat(w[1]) for w in found.ways])

        return CachedWords(compute)

    def evaluate(batches: Iterator[pa.RecordBatch]):
        known = kept(name, cache)
        types = to_arrow(FACTS).types
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [known[symbols] for symbols in part.column("symbols").to_pylist()]
                columns = [part.column(name) for name in given] + [pa.array(x, t) for x, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return blocks.mapInArrow(evaluate, schema)


def cheapest(ways: list) -> Entry:
    """The best way into a final state, with insertions at the end; ``ways`` is a row from the start."""
    done = times(ways, insertions())
    return better(*[done[end] for end in ENDS])


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Per conv_id: gaps, faults by kind, illegal neighbours, and the cheapest repair's cost and audit.

    ``rows`` has conv_id, turn, role and text; other columns are ignored. Rows go by turn (NULL
    first), then role, then a digest of the text; equal rows stay and the later ones are duplicates.
    NULL roles and texts count as one space; rows of NULL conv_id form one conversation. An empty
    table gives no conversation. ``gaps`` is greatest minus smallest turn plus one minus different
    turns, 0 if all are NULL.

    Roles and faults are symbols. A grammar of pairs is learned over all blocks of symbols; each rule
    has a matrix of cheapest ways between states, with audits as ropes that share their parts. A
    block is the product of its rules, and a conversation of its blocks, in order. The audit of a
    conversation, a letter or so per row, is the only thing that one task holds whole.
    """
    blocks = blocks_of(rows)
    facts = block_facts(blocks, learn(blocks))
    ordered = facts.repartition("conv_id").sortWithinPartitions("conv_id", *BLOCK)
    schema = T.StructType([blocks.schema["conv_id"], *REPORT.fields])

    def fold(batches: Iterator[pa.RecordBatch]):
        arrow = to_arrow(schema)
        conv, counts, last, ways, made, open_ = None, None, None, None, [], False

        def close():
            cost, audit = cheapest(ways)
            made.append((conv, *counts, cost, flat(audit)))

        for batch in batches:
            names = ["conv_id", *FACTS.fieldNames()]
            for key, blank, duplicate, truncated, illegal, first, final, costs, audits in zip(*[batch.column(n).to_pylist() for n in names]):
                if open_ and key != conv:
                    close()
                    open_ = False
                if not open_:
                    conv, counts, last, open_ = key, [0, 0, 0, 0], None, True
                    ways = [(0, "") if state == START else None for state in range(STATES)]
                more = 0 if last is None else unlawful(last, first)
                counts = [a + b for a, b in zip(counts, (blank, duplicate, truncated, illegal + more))]
                ways = times(ways, [None if c is None else (c, a) for c, a in zip(costs, audits)])
                last = final
            if len(made) > 5_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), arrow.types)], schema=arrow)
                made = []
        if open_:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), arrow.types)], schema=arrow)

    turns = rows.groupBy("conv_id").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("n"))
    gaps = turns.select(F.col("conv_id").alias("_ll_c"), F.coalesce(F.expr("high - low + 1 - n"), F.lit(0)).cast("long").alias("gaps"))
    report = ordered.mapInArrow(fold, schema).join(gaps, F.col("conv_id").eqNullSafe(F.col("_ll_c")))
    return stored(report.select("conv_id", "gaps", *REPORT.fieldNames()))


REPAIRED = T.StructType(
    [T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
)


def repaired_rows(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place from 0, edit (K, R or I), turn, role, text.

    A conversation's audit goes ahead of its rows, which pass by in order, so a task holds a batch
    of rows and an audit. Rows of a conversation stand together and in order. Inserted rows have
    no turn and an empty text; a conversation that is repaired to nothing has no rows.
    """
    plain = prepared(rows).withColumn("_ll_audit", F.lit(None).cast("string"))
    heads = report.select("conv_id", *[F.lit(None).cast(plain.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "_ll_key")], F.col("audit").alias("_ll_audit"))
    both = heads.unionByName(plain).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.col("_ll_audit").isNull(), "turn", "role", "_ll_key").select("conv_id", "turn", "role", "text", "_ll_audit")
    schema = T.StructType([plain.schema["conv_id"], plain.schema["turn"], *REPAIRED.fields])

    def apply(batches: Iterator[pa.RecordBatch]):
        arrow = to_arrow(schema)
        conv, audit, at, place, following = None, "", 0, 0, "user"

        def put(edit, turn, role, text):
            nonlocal place, following
            made.append((conv, turn, place, edit, role, text))
            place += 1
            following = "assistant" if role[:1] == "u" else "user"

        def insert():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put("I", None, following, "")
                at += 1

        for batch in batches:
            made: list = []
            for key, turn, role, text, head in zip(*[column.to_pylist() for column in batch.columns]):
                if head is not None:
                    insert()
                    conv, audit, at, place, following = key, head, 0, 0, "user"
                    continue
                insert()
                edit = audit[at]
                at += 1
                if edit != "D":
                    put(edit, turn, role if edit == "K" else following, text)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made) if made else [[]] * 6, arrow.types)], schema=arrow)
        made = []
        insert()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), arrow.types)], schema=arrow)

    return both.mapInArrow(apply, schema)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """sha256 of each conversation's ``role:text`` lines, for rows as ``repaired_rows`` leaves them."""
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]):
        arrow = to_arrow(schema)
        conv, state = None, None
        for batch in batches:
            done = []
            for key, place, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "place", "role", "text")]):
                if place == 0:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), arrow.types)], schema=arrow)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], arrow.types[0]), pa.array([state.hexdigest()])], schema=arrow)

    return repaired.mapInArrow(digest, schema)


# ---- the query's damage -------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of full stops, repeated or given to the user, by a hash of their key."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (
        rows.withColumn("_ll_kind", kind)
        .filter("_ll_kind != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_ll_kind") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("_ll_kind") == 1, "").when(F.col("_ll_kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_ll_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_ll_copy"),
        )
        .drop("_ll_copy")
    )


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table, damaged and repaired; zeros where no row is left."""
    rows = damaged(conversations)
    report = repair_conversations(rows)
    digests = repaired_digests(repaired_rows(rows, report)).withColumnRenamed("conv_id", "_ll_c")
    found = report.join(digests, F.col("conv_id").eqNullSafe(F.col("_ll_c")), "left").drop("_ll_c").withColumnRenamed("conv_id", "_ll_c")
    every = conversations.select("conv_id").distinct()
    whole = every.join(found, F.col("conv_id").eqNullSafe(F.col("_ll_c")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
