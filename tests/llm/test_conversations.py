import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from rewardseg.llm import conversations as trie
from rewardseg.llm.common import table

from .conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, n long, k1 string, leaf string"


def turn_key(turn, role, text):
    content = f"{len(role)}:{role}{text}"
    return (turn is not None, turn or 0, hashlib.md5(content.encode()).hexdigest())


def original(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((turn_key(t, r or "", x or ""), (r or "", x or "")))
    return {c: [turn for _, turn in sorted(v)] for c, v in by.items()}


def rebuilt(rows):
    own = original(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(first, [])[:h] + turns[h:]
    return out


def brute(seqs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        ends[tuple(s)].append(c)
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:d]] += not children[n]
    return rows_sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
                        hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in list(members.items()))


def rows_sorted(rows):
    return sorted((tuple(r)[:8] for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7, None, "z") for r in rows], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    rows = [(None, 0, "user", "no conversation"), (1, None, "user", "unnumbered"), (1, 0, None, None), (1, 0, None, None), (1, 3, "user", "é 😀"),
            (200, 0, "user", "hi"), (200, 1, "assistant", ""), (-7, 0, "user", "below zero"), (-107, 0, "user", "below zero"),
            (9000000001, 5, "user", "hi")]
    for c in range(300, 340):  # copies of one start, ends at many depths
        rows += [(c, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(rng.randrange(0, 12))]
    for c in (400, 401, 402, 477):  # several blocks
        rows += [(c, t, "user", f"long {t}" if t < 30 else f"long {t} {c}") for t in range(41 if c > 400 else 35)]
    rows += [(500 + i, 0, "user", "the same turn") for i in range(60)]
    rng.shuffle(rows)
    return rows


def test_sequences_as_they_are_equal_brute_force(spark):
    rows = odd_rows()
    got = trie.prefix_trie(trie.sequences(frame(spark, rows)))
    assert rows_sorted(got.collect()) == brute(original(rows))


def test_rebuilt_conversations_equal_brute_force(spark):
    rows = odd_rows()
    got = trie.prefix_trie(trie.rebuilt(frame(spark, rows))).collect()
    assert rows_sorted(got) == brute(rebuilt(rows))
    names = {r.node: r for r in got}
    assert len(names) == len(got) and all(names[r.parent_node].depth == r.depth - 1 for r in got if r.depth)


def test_one_conversation_over_many_tasks(spark):
    rows = [(100, t, "user", f"turn {t}") for t in range(700)] + [(101 + c, t, "user", f"turn {t}") for c in range(40) for t in range(9)]
    got = trie.prefix_trie(trie.rebuilt(frame(spark, rows))).collect()
    assert rows_sorted(got) == brute(rebuilt(rows))


def test_long_lists_of_ends(spark):
    rows = [(600 + i, 0, "user", "the same turn") for i in range(90)] + [(600, 1, "user", "goes on")]
    ends = trie.ends_hash(trie.blocks(trie.sequences(frame(spark, rows))), chunk_ids=7).collect()
    assert sorted(r.ends_sha256 for r in ends) == sorted(
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for ids in ([600], range(601, 690)))


def test_empty_table_and_texts(spark):
    assert trie.prefix_trie(trie.rebuilt(frame(spark, []))).count() == 0
    conversations = frame(spark, [(100, 0, "user", "hi"), (100, 1, None, None)])
    got = trie.turn_texts(trie.prefix_trie(trie.sequences(conversations)), conversations).collect()
    assert {(r.depth, r.role, r.text) for r in got} == {(0, None, None), (1, "user", "hi"), (2, "", "")}


@pytest.mark.parametrize("sf", [SF])
def test_query_equals_brute_force_and_sql(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = trie.op11_conversation_trie(spark, sf)
    names = got.columns
    assert rows_sorted(got.collect()) == brute(rebuilt(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.execute(trie.op11_sql())
    assert [d[0] for d in want.description] == names
    assert rows_sorted(want.fetchall()) == brute(rebuilt(rows))
