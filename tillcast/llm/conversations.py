"""Operator 11, conversation structure repair: the cheapest edits that make roles run as ``(s?(ua)+)?``.

A conversation's rows and the four states of that pattern span a lattice: row i done, state reached. Edges keep (0) or
rerole (2) or delete (3) the next row, or insert an empty turn (2); a row that stays truncated adds 1, and blank or
repeated rows can only be deleted. Bidirectional Dijkstra finds the cheapest way: a heap from the first row and one from
the ends meet; both go on while a way of equal cost may still cross; of all crossings at the least cost, the one with the
ASCII-least audit (the letters K, R, D, I in order) wins. A letter and a state fix the role that a row gets, so an audit
says what is repaired.

Equal-cost ways to one node never are prefixes of each other: letters fix the way, and a way that comes back to its node
costs more. So the least audit to a node stays the least whatever follows, and a conversation beyond BLOCK rows is solved
block by block, four entry by four exit states, holding four audits and one block.

Rows travel twice by conversation. First without texts, as flags and 128-bit digests, which settle faults and audit; then
texts stream once past their audit, so no conversation is held whole. A conversation is one hash and one row of the
result, so its rows end in one task, sorted on disk where they don't fit.

Nulls in role and text are read as one space. Rows come by turn, nulls first; rows of one turn by digest, repeated rows
next to each other. An empty or very long text is a text like others. A null conversation id is a conversation. A
conversation none of whose rows are left has zeros, an empty audit and the hash of an empty text; an empty table gives no
rows. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import table, written

#: States of the pattern: nothing yet, after s, after u, after a; and the role a state waits for.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ("u", "u", "a", "u")
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows of a conversation that are solved at once.
BLOCK = 2048
#: Neighbouring roles that are as they should be.
LEGAL = {"su", "ua", "au"}


# --- the lattice ----------------------------------------------------------------------------


class Lattice:
    """Edges among (row, state); a row is its role's initial, whether it must go, and whether it is truncated."""

    def __init__(self, rows: list[tuple[str, bool, bool]]):
        self.rows, self.n = rows, len(rows)
        self.into: dict[tuple[int, str], list[int]] = {}
        for (state, role), after in AFTER.items():
            self.into.setdefault((after, role), []).append(state)

    def forward(self, i: int, state: int) -> Iterator[tuple[int, int, str, int]]:
        """(row, state, letter, cost) of the edges that leave a node."""
        wanted = AFTER[state, NEXT[state]]
        yield i, wanted, "I", INSERT
        if i < self.n:
            role, gone, cut = self.rows[i]
            yield i + 1, state, "D", DELETE
            if not gone:
                yield i + 1, wanted, "R", REROLE + TRUNCATED * cut
                if (state, role) in AFTER:
                    yield i + 1, AFTER[state, role], "K", TRUNCATED * cut

    def backward(self, i: int, state: int) -> Iterator[tuple[int, int, str, int]]:
        """(row, state, letter, cost) of the edges that reach a node."""
        before = [s for s in range(4) if AFTER[s, NEXT[s]] == state]
        for s in before:
            yield i, s, "I", INSERT
        if i:
            role, gone, cut = self.rows[i - 1]
            yield i - 1, state, "D", DELETE
            if not gone:
                for s in before:
                    yield i - 1, s, "R", REROLE + TRUNCATED * cut
                for s in self.into.get((state, role), ()):
                    yield i - 1, s, "K", TRUNCATED * cut


class Side:
    """One heap of the search. Of equal cost, nodes nearer to the side's own end come first, so that a node is settled
    only when all its cheapest neighbours, which a free edge may join, are."""

    def __init__(self, sources: list[tuple[int, int]], sign: int):
        self.cost = dict.fromkeys(sources, 0)
        self.link: dict[tuple[int, int], tuple[tuple[int, int], str, int]] = {}  # the next node towards the source, its letter, letters in all
        self.heap = [(0, sign * i, state) for i, state in sources]
        heapq.heapify(self.heap)
        self.settled: set[tuple[int, int]] = set()
        self.sign = sign

    def top(self) -> float:
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def pop(self) -> tuple[int, int]:
        _, i, state = heapq.heappop(self.heap)
        node = self.sign * i, state
        self.settled.add(node)
        return node

    def length(self, node) -> int:
        return self.link[node][2] if node in self.link else 0

    def letters(self, node) -> str:
        """Letters between a node and its source, read from the node."""
        out = []
        while node in self.link:
            node, letter, _ = self.link[node]
            out.append(letter)
        return "".join(out)

    def relax(self, node, cost: int, by, letter: str) -> None:
        known = self.cost.get(node)
        if known is None or cost < known or cost == known and self.less((by, letter), self.link.get(node)):
            if cost != known:
                heapq.heappush(self.heap, (cost, self.sign * node[0], node[1]))
            self.cost[node], self.link[node] = cost, (by, letter, self.length(by) + 1)

    def less(self, new, held) -> bool:
        raise NotImplementedError


class Ahead(Side):
    """From the first row. Ways to a node are told apart where they last parted."""

    def less(self, new, held) -> bool:
        if held is None:
            return False
        (a, x), (b, y) = new, held[:2]
        while a != b:
            if self.length(a) >= self.length(b):
                a, x, _ = self.link[a]
            else:
                b, y, _ = self.link[b]
        return x < y


class Behind(Side):
    """From the ends. Ways from a node are told apart at the first letter that differs."""

    def less(self, new, held) -> bool:
        if held is None:
            return False
        (a, x), (b, y) = new, held[:2]
        while x == y and a != b and a in self.link and b in self.link:
            a, x, _ = self.link[a]
            b, y, _ = self.link[b]
        if x != y:
            return x < y
        return a != b and a not in self.link


def cheapest(rows: list[tuple[str, bool, bool]], entry: int = START, exits: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """(cost, least audit) from the entry state before the rows to one of the exit states after them; None if there is no way."""
    lattice = Lattice(rows)
    ahead, behind = Ahead([(0, entry)], 1), Behind([(lattice.n, s) for s in exits], -1)
    best = float("inf")
    while ahead.top() + behind.top() <= best and ahead.top() + behind.top() < float("inf"):
        side, other, edges = (ahead, behind, lattice.forward) if ahead.top() <= behind.top() else (behind, ahead, lattice.backward)
        node = side.pop()
        if node in other.cost:
            best = min(best, side.cost[node] + other.cost[node])
        for i, state, letter, cost in edges(*node):
            if (i, state) not in side.settled:
                side.relax((i, state), side.cost[node] + cost, node, letter)
            if (i, state) in other.cost:
                best = min(best, side.cost[node] + cost + other.cost[i, state])
    if best == float("inf"):
        return None
    # Every cheapest way leaves what is settled from the front once: at its end, or by an edge to what is settled from behind.
    audits = [ahead.letters(node)[::-1] for node in ((lattice.n, s) for s in exits) if node in ahead.settled and ahead.cost[node] == best]
    for node in behind.settled:
        if node not in ahead.settled:
            for i, state, letter, cost in lattice.backward(*node):
                if (i, state) in ahead.settled and ahead.cost[i, state] + cost + behind.cost[node] == best:
                    audits.append(ahead.letters((i, state))[::-1] + letter + behind.letters(node))
    return int(best), min(audits)


class Repair:
    """Least audit of a conversation whose rows come one after another."""

    def __init__(self):
        self.rows: list[tuple[str, bool, bool]] = []
        self.reached: dict[int, tuple[int, str]] = {START: (0, "")}

    def add(self, role: str, gone: bool, cut: bool) -> None:
        self.rows.append((role, gone, cut))
        if len(self.rows) >= BLOCK:
            self.reached = self.through(range(4))
            self.rows = []

    def through(self, exits) -> dict[int, tuple[int, str]]:
        """(cost, audit) by state behind the rows held."""
        found: dict[int, tuple[int, str]] = {}
        for after in exits:
            for state, (cost, audit) in self.reached.items():
                way = cheapest(self.rows, state, (after,))
                if way and (after not in found or (cost + way[0], audit + way[1]) < found[after]):
                    found[after] = cost + way[0], audit + way[1]
        return found

    def end(self) -> tuple[int, str]:
        if list(self.reached) == [START]:
            cost, audit = self.reached[START]
            rest = cheapest(self.rows)
            return cost + rest[0], audit + rest[1]
        return min(self.through(ENDS).values())


# --- rows -----------------------------------------------------------------------------------


SPACE = "[\\x20\\x09-\\x0D]"


def last_mark(text: Column) -> Column:
    """The last character that is no blank; empty if there is none."""
    return F.substring(F.regexp_replace(text, f"{SPACE}+\\z", ""), -1, 1)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows as the query damages them, with ``dropped`` for those it drops: by crc32 of ``conv_id:turn`` modulo 20."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", "role", "text", fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("fate") == 0).alias("dropped"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def marked(conversations: DataFrame) -> DataFrame:
    """Rows with initial, faults that show in themselves, and a digest of role and text; a row may be marked ``dropped``."""
    dropped = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), dropped.alias("dropped"),
    )
    # The length of the role keeps (role, text) apart from another pair with the same joined text.
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    last = last_mark(F.col("text"))
    return rows.select(
        "conv_id", "turn", "role", "text", "dropped", digest.alias("digest"), F.substring("role", 1, 1).alias("initial"),
        (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("truncated"),
    )


def with_duplicates(rows: DataFrame) -> DataFrame:
    """Adds ``repeated``: an earlier row of the conversation has the same role and text. Rows must lie by conversation."""
    earlier = F.row_number().over(Window.partitionBy("conv_id", "digest", "dropped").orderBy(F.asc_nulls_first("turn")))
    return rows.withColumn("repeated", earlier > 1)


FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
FLAGS = ["conv_id", "turn", "initial", "dropped", "blank", "repeated", "truncated"]
FOUND_ARROW = pa.schema([(c, pa.string() if c == "audit" else pa.int64()) for c in re.findall(r"(\w+) (?:long|string)", FOUND)])
TURNS_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


class Conversation:
    """Faults and repair of one conversation, row by row."""

    def __init__(self, conv_id):
        self.conv_id, self.repair = conv_id, Repair()
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, initial, blank, repeated, truncated) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += truncated and not (blank or repeated)
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.before = initial
        self.repair.add(initial, blank or repeated, truncated and not (blank or repeated))

    def row(self) -> tuple:
        cost, audit = self.repair.end()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """Faults, cost and audit of each conversation, from rows marked and in order, without texts."""

    def run(batches):
        held = None
        for batch in batches:
            out, columns = [], batch.to_pydict()
            for conv, turn, initial, dropped, blank, repeated, truncated in zip(*(columns[c] for c in FLAGS), strict=True):
                if held is None or held.conv_id != conv:
                    if held is not None:
                        out.append(held.row())
                    held = Conversation(conv)
                if not dropped:
                    held.add(turn, initial, blank, repeated, truncated)
            if out:
                yield batch_of(out, FOUND_ARROW)
        if held is not None:
            yield batch_of([held.row()], FOUND_ARROW)

    return rows.select(*FLAGS).mapInArrow(run, FOUND)


def repaired(audit: str, rows: Iterator[tuple[str, str, str]]) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of the turns that an audit makes of (initial, role, text) rows."""
    state = START
    for letter in audit:
        if letter == "I":
            role, text, initial = ROLES[NEXT[state]], "", NEXT[state]
        else:
            initial, role, text = next(rows)
            if letter == "D":
                continue
            if letter == "R":
                initial, role = NEXT[state], ROLES[NEXT[state]]
        state = AFTER[state, initial]
        yield letter, role, text


def with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows behind the audit of their conversation, in one stream."""
    own = found.select("conv_id", F.lit(0).alias("kind"), "audit", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), *[F.lit(None).cast("string").alias(c) for c in ("initial", "role", "text")])
    turns = rows.where("not dropped").select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "digest", "initial", "role", "text")
    return own.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "digest")


def streamed(batches) -> Iterator[tuple[object, str, Iterator]]:
    """(conversation, audit, its rows) one after another; the rows must be read before the next."""

    def flat():
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                columns = batch.slice(k, 256).to_pydict()
                yield from zip(*(columns[c] for c in ("conv_id", "kind", "audit", "initial", "role", "text")), strict=True)

    stream = flat()
    head = next(stream, None)
    while head is not None:
        conv, _, audit, *_ = head
        head = None

        def own():
            nonlocal head
            for row in stream:
                if row[1] == 0:
                    head = row
                    return
                yield row[3:]

        rows = own()
        yield conv, audit, rows
        for _ in rows:
            pass


def digests(ordered: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines joined by newlines."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches):
        out = []
        for conv, audit, rows in streamed(batches):
            sha, gap = hashlib.sha256(), b""
            for _, role, text in repaired(audit, rows):
                sha.update(gap + role.encode() + b":" + text.encode())
                gap = b"\n"
            out.append((conv, sha.hexdigest()))
            if len(out) >= 4096:
                yield batch_of(out, schema)
                out = []
        if out:
            yield batch_of(out, schema)

    return ordered.mapInArrow(run, "conv_id long, repaired_sha256 string")


def repaired_turns(ordered: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of the repaired conversations."""

    def run(batches):
        out, size = [], 0
        for conv, audit, rows in streamed(batches):
            for place, (letter, role, text) in enumerate(repaired(audit, rows)):
                out.append((conv, place, letter, role, text))
                size += len(text) + 64
                if size > 1 << 20:
                    yield batch_of(out, TURNS_ARROW)
                    out, size = [], 0
        if out:
            yield batch_of(out, TURNS_ARROW)

    return ordered.mapInArrow(run, "conv_id long, place long, edit string, role string, text string")


def find_repairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows as marked, faults and audit of each conversation)."""
    rows = marked(conversations)
    narrow = rows.drop("role", "text").repartition("conv_id")
    flagged = with_duplicates(narrow).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest")
    return rows, written(audits(flagged))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The repaired turns (conv_id, place, edit, role, text)."""
    rows, found = find_repairs(conversations)
    return repaired_turns(with_audits(rows, found))


def op11_conversation_repair(spark, folder: str) -> DataFrame:
    rows, found = find_repairs(damage(table(spark, folder, "conversations")))
    sums = digests(with_audits(rows, found)).withColumnRenamed("conv_id", "_own")
    return found.join(sums, F.col("conv_id").eqNullSafe(F.col("_own"))).drop("_own")
