"""Conversation structure repair: cheapest edits to a legal order of roles, found by an auction shortest-path algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.session import bound_arrow_batches, materialise

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Edit costs; an undeleted truncated turn adds ``CUT``.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Rows of the sorted conversations that one lattice takes: 2**BLOCK_SHIFT.
BLOCK_SHIFT = 8
FAR = 1 << 60

# States of the role grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The one user or assistant turn that may follow each state, and where it leads.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Codes of a turn's role initial and of its fault.
INITIALS, OTHER = {"s": 0, "u": 1, "a": 2}, 3
SOUND, TRUNCATED, GONE = 0, 1, 2
LEGAL_PAIRS = {(0, 1), (1, 2), (2, 1)}


def kept_state(state: int, initial: int) -> int | None:
    """Where a turn that keeps its role leads, None if its initial may not come next."""
    if initial == 0:
        return SYSTEM if state == START else None
    return NEXT[state] if initial < OTHER and NEXT[state] == (USER, ASSISTANT)[initial - 1] else None


def arcs(items: tuple, row: int, state: int, inserts: bool) -> list[tuple[int, str, tuple[int, int]]]:
    """(cost, letters, node) of the edits at a node, by letter. ``items`` are (initial * 3 + fault, copies): of copies after the
    first, and of all where the fault is GONE, each must be deleted."""
    out = []
    if row < len(items):
        code, n = items[row]
        initial, fault = divmod(code, 3)
        out.append((DELETE * n, "D" * n, (row + 1, state)))
        if fault != GONE:
            rest, extra = n - 1, CUT if fault == TRUNCATED else 0
            after = kept_state(state, initial)
            if after is not None:
                out.append((KEEP + extra + DELETE * rest, "K" + "D" * rest, (row + 1, after)))
            out.append((REROLE + extra + DELETE * rest, "R" + "D" * rest, (row + 1, NEXT[state])))
    if inserts:
        out.append((INSERT, "I", (row, NEXT[state])))
    return sorted(out, key=lambda a: a[1])


@lru_cache(maxsize=1 << 15)
def solve(items: tuple, exits: tuple, inserts_at_end: bool = False) -> tuple[tuple, tuple]:
    """(price of each entry state: what its cheapest edits cost up to and with ``exits``, what leaving in each state costs;
    (letters, exit state) of the ASCII-least cheapest edits from each entry state, None where there are none).

    An auction: every node (row, state) has a price that never exceeds the cost of an arc plus the price it leads to. From each
    node in turn, last rows first, a path is extended along an arc where both are equal; where none is, the price of
    the path's last node rises to the cheapest arc's and the path contracts by that node. A path that reaches a node whose
    price has converged makes its own nodes' prices exact. Then the arcs where prices are tight are those of the
    cheapest paths, and taking the least letter at each node gives the least string: a node's letters differ, and no
    cheapest string is the start of another one between the same nodes.
    """
    n = len(items)
    price = [[0] * 4 for _ in range(n + 1)]
    done = [[False] * 4 for _ in range(n + 1)]
    links: list[list[list]] = [[[] for _ in range(4)] for _ in range(n + 1)]
    for row in range(n, -1, -1):
        alive = [row == n and exits[q] < FAR for q in range(4)]
        at = [arcs(items, row, q, row < n or inserts_at_end) for q in range(4)]
        for _ in range(3):  # inserts lead on within the row, twice at most before they come round
            alive = [alive[q] or any(alive[to[1]] if to[0] == row else price[to[0]][to[1]] < FAR for _, _, to in at[q]) for q in range(4)]
        for q in range(4):
            if alive[q]:
                links[row][q] = [a for a in at[q] if (alive[a[2][1]] if a[2][0] == row else price[a[2][0]][a[2][1]] < FAR)]
            else:
                price[row][q] = FAR
        for origin in (q for q in range(4) if alive[q] and not done[row][q]):
            path = [(row, origin)]
            while not done[path[-1][0]][path[-1][1]]:
                i, q = path[-1]
                least, to = (exits[q], None) if i == n and exits[q] < FAR else (FAR, None)
                for cost, _, (j, r) in links[i][q]:
                    if cost + price[j][r] < least:
                        least, to = cost + price[j][r], (j, r)
                if price[i][q] < least:  # contraction
                    price[i][q] = least
                    if len(path) > 1:
                        path.pop()
                elif to is None:  # the way out
                    break
                else:  # extension
                    path.append(to)
            for i, q in path:
                done[i][q] = True
    traces = []
    for state in range(4):
        if price[0][state] >= FAR:
            traces.append(None)
            continue
        letters, i, q = [], 0, state
        while not (i == n and price[i][q] == exits[q]):
            letter, (i, q) = next((s, to) for cost, s, to in links[i][q] if cost + price[to[0]][to[1]] == price[i][q])
            letters.append(letter)
        traces.append(("".join(letters), q))
    return tuple(price[0]), tuple(traces)


#: What the end of a conversation costs in each state, and the edits that it takes there.
END_PRICES, END_TRACES = solve((), (0, FAR, FAR, 0), True)


def crossing(items: tuple) -> list[int]:
    """Least cost from each entry state (slow) to each exit state (fast), FAR where there is no way."""
    ways = [solve(items, tuple(0 if q == out else FAR for q in range(4)))[0] for out in range(4)]
    return [ways[out][state] for state in range(4) for out in range(4)]


def text_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``conversations`` with faults put in by crc32(conv_id:turn) % 20: 0 drops the row, 1 empties
    its text, 2 takes out its [.!?], 3 repeats it, 4 makes it the user's. Nulls count as one space, also in the checksum;
    conv_id and turn stay null in the result."""
    fault = F.crc32(F.concat(text_of(F.col("conv_id")), F.lit(":"), text_of(F.col("turn"))).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of(F.col("role")).alias("role"), text_of(F.col("text")).alias("text"), fault.alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1)))
    return rows.filter("_fault <> 0").select("conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


SEGMENT = (
    "_conv {conv}, _turn long, _role string, _key binary, _block long, whole boolean, codes array<int>, copies array<long>, blank long, duplicate long, truncated long, illegal long,"
    " first int, last int, low long, high long, n_turns long, first_turn long, last_turn long, ways array<long>"
)
EDITED = "_conv {conv}, pos long, role string, text string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
COUNTS = ("blank", "duplicate", "truncated")


def segments_of(table: pa.Table) -> dict[str, list]:
    """One row for each conversation of a block: its turns' codes, counts, ends, and costs across unless it is all here."""
    rows = sorted(table.to_pylist(), key=lambda r: r["_at"])
    cuts = [i for i in range(len(rows) + 1) if i in (0, len(rows)) or rows[i]["_conv"] != rows[i - 1]["_conv"]]
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = rows[a:b]
        s = {k: part[0][k] for k in ("_conv", "_turn", "_role", "_key", "_block")} | dict.fromkeys((*COUNTS, "illegal"), 0)
        s |= {"whole": 0 < a and b < len(rows), "codes": [], "copies": []}
        before = None
        for r in part:
            n, initial = r["n"], INITIALS.get(r["initial"], OTHER)
            again = r["dup"] and not r["blank"]
            fault = GONE if r["blank"] or again else TRUNCATED if r["cut"] else SOUND
            s["codes"].append(initial * 3 + fault)
            s["copies"].append(n)
            s["blank"] += n if r["blank"] else 0
            s["duplicate"] += 0 if r["blank"] else n if again else n - 1
            s["truncated"] += fault == TRUNCATED
            s["illegal"] += n - 1 + (before is not None and (before, initial) not in LEGAL_PAIRS)
            before = initial
        turns = [r["_turn"] for r in part if r["_turn"] is not None]
        s |= {"first": s["codes"][0] // 3, "last": before, "low": min(turns, default=None), "high": max(turns, default=None), "n_turns": len(set(turns))}
        s |= {"first_turn": part[0]["_turn"], "last_turn": part[-1]["_turn"]}
        s["ways"] = [] if s["whole"] else crossing(tuple(zip(s["codes"], s["copies"], strict=True)))
        out.append(s)
    return {k: [s[k] for s in out] for k in out[0]}


def repair(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """The repaired turns of each conversation, in order, each conversation closed by a row that sums it up.

    ``turns`` has conv_id, turn (a whole number), role, text; other columns are not read. A null role or text is one space, a null conv_id is a
    conversation of its own. Rows are taken by turn, nulls first, ties by role, then by SHA-256 of the text. A row's first
    fault counts: blank (nothing but spaces), duplicate (role and text of an earlier row), truncated (last character other than
    a space isn't one of .!?). Edits: keep (K, 0), re-role to user or assistant (R, 1), delete (D, 2; blanks and
    duplicates must go), insert an empty user or assistant turn (I, 5); a truncated row that stays adds 5. Result columns: conv_id; pos, role, text of
    a repaired turn; in closing rows (pos null) gaps, blank, duplicate, truncated, illegal (neighbouring role initials other
    than su, ua, au), cost and audit (the cheapest edits' initials, of equal costs the ASCII-least). Conversations named in ``every`` (conv_id) without
    rows close with zeros and an empty audit. Empty tables give an empty table.

    Rows that repeat a whole row are counted first, before the shuffle. Only narrow rows (digests, no texts) are sorted over all
    tasks by range, so that a hot conversation is spread over many, and cut into blocks of 256 rows. Each block runs the auction for what it
    has of each conversation: its costs between entry and exit states. A conversation over several blocks folds these few numbers
    from its end, then each block traces its edits from every entry state, again spread. Last, each conversation's texts stream by
    in order, with its letters. That pass holds one batch, but a conversation's audit and its order are one row and
    one task by definition.
    """
    spark = turns.sparkSession
    bound_arrow_batches(spark)
    conv = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select(F.col("conv_id").alias("_conv"), F.col("turn").cast("long").alias("_turn"), text_of(F.col("role")).alias("_role"), text_of(F.col("text")).alias("_text"))
    rows = rows.withColumn("_key", F.unhex(F.sha2("_text", 256)))
    body = F.rtrim("_text", F.lit(SPACES))
    cut = ~F.substring(body, -1, 1).isin(".", "!", "?")
    narrow = rows.select("_conv", "_turn", "_role", "_key", (body == "").alias("blank"), cut.alias("cut"))
    narrow = narrow.groupBy("_conv", "_turn", "_role", "_key").agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    order = [F.col("_conv").asc_nulls_first(), F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_key")]
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, "repair-order")
    seen = placed.groupBy("_conv", "_role", "_key").agg(F.min("_at").alias("_first"), F.count("*").alias("_times")).filter("_times > 1")
    seen = seen.select(F.col("_conv").alias("_c"), F.col("_role").alias("_r"), F.col("_key").alias("_k"), "_first")
    marked = placed.join(seen, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_role") == F.col("_r")) & (F.col("_key") == F.col("_k")), "left")
    dup = F.coalesce(F.col("_at") > F.col("_first"), F.lit(False))
    blocks = marked.select("_conv", "_turn", "_role", "_key", "blank", "cut", "n", "_at", F.shiftright("_at", BLOCK_SHIFT).alias("_block"), F.substring("_role", 1, 1).alias("initial"), dup.alias("dup"))

    segment = SEGMENT.format(conv=conv)
    kinds = spark.createDataFrame([], segment).schema
    arrow = pa_schema(kinds)

    def cut_up(table: pa.Table) -> pa.Table:
        return pa.table(segments_of(table), schema=arrow)

    found = materialise(blocks.groupBy("_block").applyInArrow(cut_up, segment), "repair-segments")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From a conversation's last block to its first: what leaving each block costs."""
        now, exits = object(), END_PRICES
        for batch in batches:
            out = []
            for c, ways in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if c != now:
                    now, exits = c, END_PRICES
                out.append(list(exits))
                exits = tuple(min(FAR, *(ways[4 * q + to] + exits[to] for to in range(4))) for q in range(4))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], names=["_c", "_b", "exits"])

    parts = found.filter("not whole").select("_conv", "_block", "ways").repartition("_conv").sortWithinPartitions("_conv", F.col("_block").desc())
    leaving = materialise(parts.mapInArrow(fold, f"_c {conv}, _b long, exits array<long>"), "repair-exits")
    joined = found.join(leaving, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_block") == F.col("_b")), "left")

    @F.arrow_udf("struct<prices: array<bigint>, letters: array<string>, states: array<int>>")
    def trace(codes: pa.Array, copies: pa.Array, exits: pa.Array) -> pa.Array:
        out = []
        for c, n, e in zip(codes.to_pylist(), copies.to_pylist(), exits.to_pylist(), strict=True):
            prices, ways = solve(tuple(zip(c, n, strict=True)), tuple(e) if e else END_PRICES)
            ways = ways if e else ways[:1]  # a whole conversation is entered at its start
            out.append({"prices": list(prices), "letters": [w and w[0] for w in ways], "states": [w and w[1] for w in ways]})
        return pa.array(out, pa.struct([("prices", pa.list_(pa.int64())), ("letters", pa.list_(pa.string())), ("states", pa.list_(pa.int32()))]))

    sums = [*COUNTS, "illegal", "first", "last", "low", "high", "n_turns", "first_turn", "last_turn"]
    traced = joined.withColumn("_way", trace("codes", "copies", "exits")).select("_conv", "_turn", "_role", "_key", F.lit(1).alias("_kind"), F.struct("_way", *sums).alias("_seg"), F.lit(None).cast("string").alias("_text"))
    wide = rows.select("_conv", "_turn", "_role", "_key", F.lit(2).alias("_kind"), F.lit(None).cast(traced.schema["_seg"].dataType).alias("_seg"), "_text")
    named = (turns if every is None else every).select(F.col("conv_id").alias("_conv")).distinct()
    opens = named.select("_conv", F.lit(None).cast("long").alias("_turn"), F.lit(None).cast("string").alias("_role"), F.lit(None).cast("binary").alias("_key"), F.lit(0).alias("_kind"), F.lit(None).cast(traced.schema["_seg"].dataType).alias("_seg"), F.lit(None).cast("string").alias("_text"))
    stream = opens.union(traced).union(wide).repartition("_conv").sortWithinPartitions(F.col("_conv").asc_nulls_first(), F.col("_turn").asc_nulls_first(), F.col("_role").asc_nulls_first(), F.col("_key").asc_nulls_first(), "_kind")
    edited = EDITED.format(conv=conv)
    edited_arrow = pa_schema(spark.createDataFrame([], edited).schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_conv", "_kind", "_seg", "_role", "_text")]
            for c, kind, seg, role, text in zip(*columns, strict=True):
                if state is None or c != state.conv:
                    if state is not None:
                        out += state.close()
                    state = Conversation(c)
                if kind == 1:
                    state.enter(seg)
                elif kind == 2:
                    out += state.row(role, text)
            yield batch_of(out, edited_arrow)
        if state is not None:
            yield batch_of(state.close(), edited_arrow)

    return stream.mapInArrow(apply, edited).withColumnRenamed("_conv", "conv_id")


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pa_schema(kinds) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kinds)


class Conversation:
    """The edits of one conversation as its segments and rows pass by in order."""

    def __init__(self, conv):
        self.conv, self.state, self.letters, self.at = conv, START, "", 0
        self.audit: list[str] = []
        self.pos, self.cost, self.sums = 0, None, dict.fromkeys((*COUNTS, "illegal"), 0)
        self.last, self.last_turn, self.low, self.high, self.n_turns = None, None, None, None, 0

    def enter(self, seg: dict) -> None:
        way = seg["_way"]
        if self.cost is None:
            self.cost = way["prices"][START]
        self.letters, self.at = way["letters"][self.state], 0
        self.state = way["states"][self.state]
        self.audit.append(self.letters)
        for k in self.sums:
            self.sums[k] += seg[k]
        if self.last is not None:
            self.sums["illegal"] += (self.last, seg["first"]) not in LEGAL_PAIRS
        self.n_turns += seg["n_turns"] - (seg["first_turn"] is not None and seg["first_turn"] == self.last_turn)
        self.low = seg["low"] if self.low is None else self.low
        self.high = self.high if seg["high"] is None else seg["high"]
        self.last, self.last_turn = seg["last"], seg["last_turn"]

    def turn(self, role: str, text: str) -> tuple:
        self.pos += 1
        return (self.conv, self.pos, role, text, *[None] * 7)

    def inserts(self) -> list[tuple]:
        """Turns put in before the next row."""
        out = []
        while self.letters[self.at : self.at + 1] == "I":
            out.append(self.turn(ROLE[self.expected()], ""))
            self.at += 1
        return out

    def expected(self) -> int:
        self.after = NEXT[self.after]
        return self.after

    after = START

    def row(self, role: str, text: str) -> list[tuple]:
        out = self.inserts()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.after = SYSTEM if role[:1] == "s" else NEXT[self.after]
            out.append(self.turn(role, text))
        elif letter == "R":
            out.append(self.turn(ROLE[self.expected()], text))
        return out

    def close(self) -> list[tuple]:
        out = []
        if self.cost is not None:
            self.letters, self.at = END_TRACES[self.state][0], 0
            self.audit.append(self.letters)
            out = self.inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.n_turns
        out.append((self.conv, None, None, None, gaps, *(self.sums[k] for k in (*COUNTS, "illegal")), self.cost or 0, "".join(self.audit)))
        return out


def summaries(edited: DataFrame) -> DataFrame:
    """One row per conversation of what ``repair`` returns: its closing row and repaired_sha256, the hash of its repaired turns as
    ``role:text`` joined by newlines. Reads the rows in their order, without another shuffle."""
    conv = edited.schema["conv_id"].dataType.simpleString()
    kinds = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = hashlib.sha256()
        for batch in batches:
            closing, hashes = [], []
            for i, (pos, role, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                if pos is None:
                    closing.append(i)
                    hashes.append(now.hexdigest())
                    now = hashlib.sha256()
                else:
                    now.update(f"{'' if pos == 1 else chr(10)}{role}:{text}".encode())
            part = batch.take(pa.array(closing, pa.int64()))
            yield pa.record_batch([part.column(0), *(part.column(k) for k in range(4, 11)), pa.array(hashes, pa.string())], names=["conv_id", "gaps", *COUNTS, "illegal", "cost", "audit", "repaired_sha256"])

    return edited.mapInArrow(digest, kinds)


#: The whole query in DuckDB: a table-driven CRC-32, and a forward table of least (cost, audit) per state in place of the auction.
SQL = r"""
WITH RECURSIVE
tab AS (SELECT list(v ORDER BY b) AS t FROM (
  SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(b))),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
      lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) % 20 AS k FROM conversations, tab),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM c)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), sha256(text)) AS i,
    left(role, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d),
f AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM o),
ids AS (SELECT DISTINCT conv_id FROM conversations),
sums AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
nxt AS (SELECT * FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) v(q, r)),
ins AS (SELECT q, 0 AS k, q AS r FROM nxt UNION ALL SELECT q, 1, r FROM nxt UNION ALL SELECT a.q, 2, b.r FROM nxt a JOIN nxt b ON a.r = b.q),
edits AS (
  SELECT f.conv_id, f.i, nxt.q, e.letter, e.cost + CASE WHEN fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END AS cost,
    CASE e.letter WHEN 'D' THEN nxt.q WHEN 'R' THEN nxt.r ELSE CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS r
  FROM f, nxt, (VALUES ('K', 0), ('R', 1), ('D', 2)) e(letter, cost)
  WHERE e.letter = 'D' OR (fault NOT IN ('b', 'd') AND (e.letter = 'R' OR (ini = 's' AND nxt.q = 0) OR (ini = 'u' AND nxt.r = 2) OR (ini = 'a' AND nxt.r = 3)))),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0::BIGINT, 'audit': ''} AS best FROM sums
  UNION ALL
  SELECT s.conv_id, s.i + 1, e.r, min({'cost': s.best.cost + 5 * n.k + e.cost, 'audit': s.best.audit || repeat('I', n.k) || e.letter})
  FROM steps s JOIN ins n ON n.q = s.q JOIN edits e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.i = s.i + 1 AND e.q = n.r GROUP BY s.conv_id, s.i, e.r),
ended AS (SELECT s.conv_id, min({'cost': s.best.cost + 5 * n.k, 'audit': s.best.audit || repeat('I', n.k)}) AS best
  FROM steps s JOIN sums m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.n = s.i JOIN ins n ON n.q = s.q AND n.r IN (0, 3) GROUP BY s.conv_id),
letters AS (SELECT conv_id, p, audit[p] AS letter, p - length(replace(audit[:p], 'I', '')) AS inserted FROM (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS p FROM ended)),
lines AS (SELECT l.conv_id, l.p, l.letter, f.role, CASE WHEN l.letter = 'I' THEN '' ELSE f.text END AS text,
    count(*) FILTER (l.letter IN ('I', 'R') OR (l.letter = 'K' AND f.ini <> 's')) OVER (PARTITION BY l.conv_id ORDER BY l.p) AS j
  FROM letters l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.p - l.inserted AND l.letter <> 'I'),
mended AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN j % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS repaired FROM lines WHERE letter <> 'D' GROUP BY conv_id)
SELECT ids.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate, coalesce(s.truncated, 0)::BIGINT AS truncated,
  coalesce(s.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit, sha256(coalesce(m.repaired, '')) AS repaired_sha256
FROM ids LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN mended m ON m.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
