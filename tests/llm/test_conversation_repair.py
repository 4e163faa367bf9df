import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from tidemark.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def cheapest(rows):
    """Least (cost, letters) and the repaired rows, over (role, text, must go, truncated), by an ordered search of whole edits."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, given, lines = heapq.heappop(heap)
        if (i, given[-1:]) in seen:
            continue
        seen.add((i, given[-1:]))
        if i == len(rows) and (not given or given[-1] == "a"):
            return cost, letters, list(lines)
        follows = [x for x in "sua" if re.fullmatch("s?(ua)*u?", given + x)]
        for x in follows:
            name = {"s": "", "u": "user", "a": "assistant"}[x]
            if name:
                heapq.heappush(heap, (cost + 3, letters + "I", i, given + x, lines + (f"{name}:",)))
            if i < len(rows):
                role, text, gone, cut = rows[i]
                if not gone and name:
                    heapq.heappush(heap, (cost + 3 + 3 * cut, letters + "R", i + 1, given + x, lines + (f"{name}:{text}",)))
                if not gone and role[:1] == x:
                    heapq.heappush(heap, (cost + 3 * cut, letters + "K", i + 1, given + x, lines + (f"{role}:{text}",)))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, given, lines))


def expected(rows):
    """Result per conversation, from the rows after damage."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0], r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, judged, n = set(), [], dict.fromkeys(C.COUNTS, 0)
        for _, _, role, text in own:
            blank, again = not text.strip(C._BLANK), (role, text) in seen
            cut = not blank and text.rstrip(C._BLANK)[-1] not in ".!?"
            seen.add((role, text))
            n["blank"] += blank
            n["duplicate"] += again and not blank
            n["truncated"] += cut and not again and not blank
            judged.append((role, text, blank or again, cut))
        n["illegal"] = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        turns = [t for _, t, _, _ in own if t is not None]
        n["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n["cost"], audit, lines = cheapest(judged)
        out[conv] = (*n.values(), audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: (*(r[c] for c in C.COUNTS), r["audit"], r["repaired_sha256"]) for r in rows}
    assert len(out) == len(rows)
    return out


def conversations(n, seed, most=9):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "no", "Why?", " ", "", None, "Stop! ", "x\n", " ", "long " * 50 + "."]
    for conv in range(n):
        for turn in range(r.randint(1, most)):
            t = r.choice([turn, turn, turn, None, 0, turn + 3])
            text = r.choice(texts) if r.random() < 0.4 else f"{r.choice('abc')} {turn}{r.choice(['.', '', '!'])}"
            yield (conv if conv else None, t, r.choice(roles), text)


def test_tables_against_an_ordered_search():
    r, t = random.Random(1), C.Tables(4)
    roles = {1: "system", 2: "user", 3: "assistant", 4: "tool"}
    for _ in range(1500):
        symbols = bytes(r.choice([0, 1, 2, 3, 3, 3, 4, 5, 5, 5, 6, 7, 8]) for _ in range(r.randint(0, 11)))
        rows = [(roles[(s + 1) // 2], "", False, not s % 2) if s else ("user", "", True, False) for s in symbols]
        audit = cheapest(rows)[1]
        assert t.trace(symbols) == audit
        cut = r.randint(0, len(symbols))
        (_, left), (right, _) = t.reduced(symbols[:cut]), t.reduced(symbols[cut:])
        behind = int.from_bytes(right[:4], "little")
        first = t.trace(symbols[:cut], behind, C.START, False)
        assert first + t.trace(symbols[cut:], 0, left[4 * behind + C.START]) == audit


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_blocks_of_any_length_agree(block):
    r, one, other = random.Random(2), C.Tables(4), C.Tables(block)
    for _ in range(300):
        symbols = bytes(r.randrange(9) for _ in range(r.randint(0, 40)))
        assert one.trace(symbols) == other.trace(symbols)


@pytest.mark.parametrize("piece", [1, 3, C.PIECE])
def test_repair_matches_the_search(spark, piece):
    rows = list(conversations(60, seed=3)) + [(77, t % 40, "user" if t % 2 else "assistant", f"{t % 7} ok.") for t in range(100)]
    rows += [(78, None, "user", "Same.")] * 30  # copies of one row
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("edit", "digest", "sym", "kind", "at", "audit", "copy"):
        df = df.withColumn(c, F.lit("x"))
    assert got(C.report(C.repair(df, piece=piece))) == expected(rows)


def test_edits_are_whole(spark):
    rows = list(conversations(30, seed=5))
    found = C.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str((r["conv_id"], r["turn"], r["role"], r["text"])) for r in found if r["edit"] != "I") == sorted(
        str((c, t, " " if r is None else r, " " if x is None else x)) for c, t, r, x in rows)
    assert all((r["new_role"] is None) == (r["edit"] == "D") for r in found)


def test_damage(spark):
    rows = [(i, t, r, x) for i in range(60) for t, r, x in ((0, "user", "Hi. a? b!"), (None, None, None))] + [(None, 3, "assistant", "A.")]
    want = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x)
        want += [row] * (0 if k == 0 else 2 if k == 3 else 1)
    found = C.damage(spark.createDataFrame(rows, SCHEMA).withColumn("copy", F.lit(1))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want)) and len(want) != len(rows)


def test_empty_table_and_a_conversation_without_rows(spark, tmpdir_fresh):
    from tidemark.llm.registry import QUERIES

    assert C.report(C.repair(spark.createDataFrame([], SCHEMA))).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "A.")], SCHEMA).write.parquet(f"{tmpdir_fresh}/one/conversations.parquet")
    assert got(QUERIES["op12_conversation_repair"](spark, f"{tmpdir_fresh}/one")) == {gone: (0,) * 6 + ("", EMPTY)}
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmpdir_fresh}/none/conversations.parquet")
    assert QUERIES["op12_conversation_repair"](spark, f"{tmpdir_fresh}/none").count() == 0


def test_query_on_repeated_and_null_rows_against_the_search(spark, tmpdir_fresh):
    from tidemark.llm.registry import QUERIES

    rows = list(conversations(80, seed=9))
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmpdir_fresh}/conversations.parquet")
    want = expected([tuple(r) for r in C.damage(df).collect()])
    want |= {c: (0,) * 6 + ("", EMPTY) for c, *_ in rows if c not in want}
    assert got(QUERIES["op12_conversation_repair"](spark, tmpdir_fresh)) == want
