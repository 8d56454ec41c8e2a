"""Repair of conversations against a search over paths, whole tables against plain Python, and rows that need care."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from broadsheet.llm import conversations as cv
from broadsheet.llm import registered

KEEPS = {("s", ""): "s", ("u", ""): "u", ("u", "s"): "u", ("u", "a"): "u", ("a", "u"): "a"}


def cheapest(rows):
    """Least cost, then least audit, over (rows consumed, last initial); rows are (initial, must go, truncated)."""
    heap, done = [(0, "", 0, "")], {}
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done[i, last] = cost, audit
        given = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, given))
        if i < len(rows):
            initial, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if not gone:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, given))
                if (initial, last) in KEEPS:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, initial))
    return min(done[len(rows), ""], done[len(rows), "a"])


def report(rows):
    """The report of one conversation, from rows (turn, role, text) in order."""
    seen, marks, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marks.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
    cost, audit = cheapest(marks)
    turns = [t for t, _, _ in rows if t is not None]
    lines, last, left = [], "", list(rows)
    for letter in audit:
        row = None if letter == "I" else left.pop(0)
        if letter == "D":
            continue
        last = row[1][:1] if letter == "K" else "a" if last == "u" else "u"
        role = row[1] if letter == "K" else {"u": "user", "a": "assistant"}[last]
        lines.append((role, row[2] if row else ""))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in lines))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()), lines


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))


def spoiled(rows):
    """{conv_id: rows (turn, role, text) after the planted damage}, from (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (turn, "user" if fault == 4 else role, text)
        kept += [] if fault == 0 else [row, row] if fault == 3 else [row]
    return out


@pytest.mark.parametrize("lengths, tries", [((0, 9), 1500), ((30, 150), 25)])
def test_runs_equal_a_search_over_paths(lengths, tries):
    rng = random.Random(7)
    for _ in range(tries):
        symbols = "".join(rng.choice("suaxSUAXduaua") for _ in range(rng.randint(*lengths)))
        want = cheapest([(s.lower(), s == "d", int(s.isupper())) for s in symbols])
        assert cv.audit_of(cv.run_table(symbols)) == want, symbols


def test_ties_take_the_least_audit():
    assert cv.audit_of(cv.run_table("")) == (0, "")
    assert cv.audit_of(cv.run_table("s")) == (3, "D")
    assert cv.audit_of(cv.run_table("a")) == (2, "IK")
    assert cv.audit_of(cv.run_table("u")) == (2, "KI")
    assert cv.audit_of(cv.run_table("uu")) == (2, "KR")
    assert cv.audit_of(cv.run_table("U")) == (3, "D")


def test_whole_table_equals_plain_python(spark, small):
    rows = [tuple(r) for r in registered.table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in registered.QUERIES["op11_conversation_repair"](spark, small).collect()}
    assert got == {conv: report(in_order(kept))[0] for conv, kept in spoiled(rows).items()}


SCHEMA = "id long, conv_id long, turn long, role string, text string, n string, piece int, audit string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(7, *r, "x", 3, "clash") for r in rows], SCHEMA).repartition(partitions)


def edge_rows():
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 3, "user", "What?"), (1, None, "user", "Hm."), (1, 0, "system", "Be kind."), (1, 0, "user", "Hello?"),
            (1, 5, "assistant", "Hi! "), (2, 0, "", ""), (2, 1, "tool", "é!"), (2, 1, "tool", "é!"), (2, 1, "tool", " \x0b.\t"), (3, 0, None, "Text."),
            (4, 2**62, "user", "Far."), (4, -5, "assistant", "Early."), (5, 0, "user", "long? " * 60_000), (5, 1, "assistant", "x" * 300_000)]
    for turn in range(700):  # one conversation in many pieces, with hot copies of one row
        rows.append((9, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "system", "User"]), rng.choice(["Same.", f"Text {turn}.", f"Cut {turn}", ""])))
    rows += [(9, 40, "user", "Hot.")] * 300 + [(8, 1, "user", " ")] * 200
    return rows


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_rows_that_need_care(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = edge_rows()
        groups = {}
        for conv, turn, role, text in rows:
            groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
        want = {conv: report(in_order(kept)) for conv, kept in groups.items()}
        data = frame(spark, rows)
        assert {r.conv_id: tuple(r)[1:] for r in cv.reports(data).collect()} == {c: w[0] for c, w in want.items()}
        lines = {}
        for r in cv.repaired(data).orderBy("conv_id", "place").collect():
            lines.setdefault(r.conv_id, []).append((r.role, r.text))
            assert r.place == len(lines[r.conv_id]) and (r.edit != "I" or (r.turn is None and r.text == ""))
        assert lines == {c: w[1] for c, w in want.items() if w[1]}
        got = {r.conv_id: tuple(r)[1:] for r in cv.damage_reports(data).collect()}
        assert got == {c: report(in_order(k))[0] for c, k in spoiled(rows).items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_conversation_without_rows_and_empty_table(spark):
    dropped = next(k for k in range(10_000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = cv.damage_reports(frame(spark, [(dropped, 0, "user", "Gone.")])).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert cv.damage_reports(frame(spark, [])).count() == 0
    assert cv.repaired(frame(spark, [])).count() == 0
