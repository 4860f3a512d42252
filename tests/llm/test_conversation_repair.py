import hashlib
import heapq
import random
import re
from collections import defaultdict


from campaignlake.llm import conversation_repair as cr
from campaignlake.llm import queries

from .util import SF, crc

SCHEMA = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        out[c]
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc(f"{' ' if c is None else c}:{' ' if t is None else t}") % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(ts, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, ts in out.items()}


def cheapest(turns):
    """(cost, audit, repaired) by a search over all edits, cheapest and then least audit first."""
    must, cut = [], []
    for i, (_, role, text) in enumerate(turns):
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        must.append(not body or (role, text) in [t[1:] for t in turns[:i]])
        cut.append(bool(body) and body[-1] not in ".!?")
    # State of the output: what a prefix of the wanted pattern can end in.
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, q, kept = heapq.heappop(heap)
        if i == len(turns) and q in ("", "a"):
            return cost, audit, list(kept)
        if (i, q) in done:
            continue
        done.add((i, q))
        for role in ("user", "assistant"):
            if (q, role[0]) in after:
                heapq.heappush(heap, (cost + 3, audit + "I", i, role[0], (*kept, (role, ""))))
        if i == len(turns):
            continue
        _, role, text = turns[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q, kept))
        if not must[i]:
            extra = 3 * cut[i]
            if (q, role[:1]) in after:
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, after[q, role[:1]], (*kept, (role, text))))
            for new in ("user", "assistant"):
                if (q, new[0]) in after:
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, new[0], (*kept, (new, text))))


def brute(rows):
    out = {}
    for c, turns in damage(rows).items():
        figures = {"blank": 0, "duplicate": 0, "truncated": 0}
        for i, (_, role, text) in enumerate(turns):
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not body else "duplicate" if (role, text) in [t[1:] for t in turns[:i]]
                     else "truncated" if body[-1] not in ".!?" else None)
            if fault:
                figures[fault] += 1
        numbers = {t[0] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        heads = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        cost, audit, kept = cheapest(turns)
        assert SHAPE.fullmatch("".join(r[:1] for r, _ in kept))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[c] = (c, gaps, *figures.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return sorted(out.values(), key=str)


def result(spark, rows, tmp):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as conv", "1 as kind", "2 as id", "'a' as audit") \
        .repartition(3).write.parquet(f"{tmp}/conversations.parquet")
    return sorted((tuple(r) for r in queries.op13_conversation_repair(spark, tmp).collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op13_conversation_repair(spark, SF).collect()), key=str)
    assert got == brute(rows) and len({r[7] for r in got}) > 5


def test_odd_input(spark, tmp):
    rng = random.Random(4)
    texts = ["A.", "B!", "cut", "", None, "  \t", "end? \n", "\x85", "tief ü.", "🙂"]
    roles = ["user", "assistant", "system", None, "", "tool", "sister", "User", "u"]
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 5, 8, 13, 21]), rng.choice(roles), rng.choice(texts))
            for c in [None, *range(150)] for _ in range(rng.randrange(1, 9))]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"long {t}." if t % 5 else "cut") for t in range(400)]
    rows += [(1001, 1, "user", "x" * 300_000), (1001, 2, "assistant", "y. " * 100_000)]
    rows += [(2000 + c, 0, "user", "alone.") for c in range(40)]  # some lose their only turn
    rows += [(3000, 1, "user", "same.")] * 30
    got = result(spark, rows, tmp)
    want = brute(rows)
    assert got == want
    assert any(r[7] == "" for r in got)


def test_empty_table(spark, tmp):
    assert result(spark, [], tmp) == []


def test_block_lookups_equal_single_steps():
    rng = random.Random(1)
    single, blocks = cr.Tables(block=1), cr.Tables()
    assert len(blocks.blocks) == len(blocks.vectors) < 100 and len(blocks.blocks[0]) == cr.SYMBOLS ** cr.BLOCK
    for n in [0, 1, 3, 4, 5, 8, 31, 1000]:
        for _ in range(20):
            symbols = [rng.randrange(cr.SYMBOLS) for _ in range(n)]
            assert single.solve(symbols) == blocks.solve(symbols)


def test_audits_against_search_on_all_short_inputs():
    tables = cr.Tables()
    turns = [(r, t) for r in ("system", "user", "assistant", "x") for t in ("1.", "1")] + [("user", "")]
    for a in turns:
        for b in turns:
            for c in turns:
                rows = [(i, r, f"{i}{t}" if t else "") for i, (r, t) in enumerate((a, b, c))]
                symbols, _ = cr.faults([(r.encode(), t.encode()) for _, r, t in rows])
                assert tables.solve(symbols) == cheapest(rows)[:2]
