"""Conversation repair against all edits tried out, and against a plain search on longer conversations."""

import hashlib
import heapq
import itertools
import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import tables as T  # noqa: E402
from tillcast.llm import conversations as C  # noqa: E402

BLANK = " \t\n\x0b\x0c\r"


def shape(roles: str) -> bool:
    """Whether initials read ``(s?(ua)+)?``."""
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or rest != "" and rest == "ua" * (len(rest) // 2)


def all_repairs(rows, most: int):
    """Least (cost, audit) over every sequence of edits of at most ``most`` letters."""
    best = None
    for size in range(most + 1):
        for letters in itertools.product(("D", "Iu", "Ia", "K", "Ru", "Ra"), repeat=size):
            if sum(x[0] != "I" for x in letters) != len(rows):
                continue
            left, roles, cost = list(rows), "", 0
            for x in letters:
                if x[0] == "I":
                    roles, cost = roles + x[1], cost + 2
                    continue
                role, gone, cut = left.pop(0)
                if x == "D":
                    cost += 3
                elif gone:
                    break
                else:
                    roles, cost = roles + (role if x == "K" else x[1]), cost + cut + 2 * (x != "K")
                    if x == "K" and role == "":
                        break
            else:
                found = cost, "".join(x[0] for x in letters)
                if shape(roles) and (best is None or found < best):
                    best = found
    return best


def plain_search(rows):
    """One heap of (cost, audit, rows done, roles state); a state is what the last role was."""
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        if (i, last) in seen:
            continue
        seen.add((i, last))
        heapq.heappush(heap, (cost + 2, audit + "I", i, wanted[last]))
        if i < len(rows):
            role, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if not gone:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, wanted[last]))
                if role == wanted[last] or role == "s" and last == "":
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, role))


def draw_rows(draw, n):
    return [(draw.choice("suuuaaax"), draw.random() < 0.2, draw.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("n", range(4))
def test_repair_is_the_least_of_all_edits(n):
    kinds = [(r, g, c) for r in "suax" for g, c in ((False, False), (False, True), (True, False))]
    draw = random.Random(n)
    for rows in itertools.product(kinds, repeat=n) if n < 3 else (draw_rows(draw, 3) for _ in range(12)):
        assert C.cheapest(list(rows)) == all_repairs(rows, n + 2 if n < 3 else 6), rows


def test_bidirectional_search_equals_a_plain_one():
    draw = random.Random(11)
    for _ in range(1500):
        rows = draw_rows(draw, draw.randrange(25))
        assert C.cheapest(rows) == plain_search(rows), rows


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_give_what_the_whole_gives(monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    draw = random.Random(block)
    for _ in range(150):
        rows = draw_rows(draw, draw.randrange(18))
        repair = C.Repair()
        for row in rows:
            repair.add(*row)
        assert repair.end() == plain_search(rows), rows


def test_a_long_conversation_is_solved_in_blocks():
    rows = draw_rows(random.Random(5), 5000)
    repair = C.Repair()
    for row in rows:
        repair.add(*row)
    assert repair.end() == plain_search(rows)


def plain_result(rows, damaged=True):
    """What the query returns for rows of (conv_id, turn, role, text), by conversation."""
    space = lambda x: " " if x is None else x
    left = defaultdict(list)
    for conv, turn, role, text in rows:
        own = left[conv]
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20 if damaged else 9
        role, text = space(role), space(text)
        if fate == 1:
            text = ""
        elif fate == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif fate == 4:
            role = "user"
        if fate:
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own += [(turn is not None, turn or 0, key, role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, own in left.items():
        own.sort()
        seen, faults, lattice = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, _, _, role, text in own:
            last = text.rstrip(BLANK)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            lattice.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for known, t, *_ in own if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[0] for r in lattice]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = plain_search(lattice)
        lines, rows_left, last = [], list(own), ""
        for letter in audit:
            row = None if letter == "I" else rows_left.pop(0)
            if letter == "D":
                continue
            if letter != "K":
                last = "a" if last == "u" else "u"
                lines.append(("user" if last == "u" else "assistant") + ":" + (row[4] if row else ""))
            else:
                last = row[3][:1]
                lines.append(f"{row[3]}:{row[4]}")
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_equals_the_plain_version_on_edge_rows(spark, tmp_path):
    expected = plain_result(T.conversations())
    rows = C.op11_conversation_repair(spark, T.folder(tmp_path)).collect()
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(rows) == len(expected) and found == expected
    assert any(r["audit"] == "" for r in rows)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are absent")
def test_query_equals_the_plain_version_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in C.op11_conversation_repair(spark, "/root/testdata/sf0.001").collect()}
    assert found == plain_result(rows)


def test_repaired_turns_have_the_pattern_and_hash_alike(spark):
    data = T.conversations()
    table = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    expected = plain_result(data, damaged=False)
    by_conv = defaultdict(list)
    for r in C.repair_conversations(table).orderBy("conv_id", "place").collect():
        by_conv[r["conv_id"]].append(r)
    for conv, rest in expected.items():
        turns = by_conv[conv]
        assert [r["place"] for r in turns] == list(range(len(turns)))
        assert shape("".join(r["role"][:1] for r in turns))
        assert "".join(r["edit"] for r in turns) == rest[6].replace("D", "")
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in turns).encode()).hexdigest() == rest[7]
