import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cohortwise.llm import conversation_trie as trie

ROWS = "conv_id long, turn long, role string, text string"


def brute(rows, group=5, heads=9):
    """All prefixes of the rebuilt conversations, from their lists of turns."""
    told = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in told.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        seq = own.get(c - c % group, [])[:h] + mine[h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], sha(ends[k])) for k, m in members.items()), key=str)


def found(df, **how):
    return sorted((tuple(r) for r in trie.nodes(df, **how).collect()), key=str)


def test_nodes_of_given_tables(spark, small):
    df = spark.read.parquet(f"{small}/conversations.parquet")
    assert found(df) == brute([tuple(r) for r in df.collect()])


def test_odd_rows_deep_edges_and_shared_turns(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 60) for t in range(1 + c % 7)]          # prefixes of each other
    rows += [(c, t, "user", f"turn {t}" if t < c % 23 else f"own {c}") for c in range(100, 140) for t in range(24)]  # long edges, cut at many depths
    rows += [(200, None, None, None), (200, 0, "user", ""), (200, 0, "user", ""), (201, 5, None, "x" * 50_000), (None, 0, "user", "lost"), (-7, 1, "a", "b"), (-8, 1, "a", "b")]
    df = spark.createDataFrame(rows, ROWS)
    assert found(df) == brute(rows)
    assert found(df, group=1, heads=1) == brute(rows, 1, 1)


def test_hot_conversation_ids_come_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = [(c * 5, 0, "user", "the same") for c in range(300)]
    assert found(spark.createDataFrame(rows, ROWS)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], ROWS)) == []
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (6, 1, "user", "b")]
    clash = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("?") for c in ("path", "hi", "depth", "top", "first", "n", "turns")})
    assert found(clash) == brute(rows)


def test_search_uses_the_handles(spark):
    """Probes of the fat binary search: every handle is the two-fattest depth of its edge, and a key of the trie finds its own end."""
    paths = trie.with_path(trie.rebuilt(spark.createDataFrame([(c, t, "u", f"{t if t < c else -c}") for c in range(1, 20) for t in range(20)], ROWS), 1, 1)).cache()
    nodes = trie.build(paths)
    for r in nodes.withColumn("f", trie.fattest(F.col("top"), F.col("extent"))).collect():
        best = max(range(r.top + 1, r.extent + 1), key=lambda d: d & -d)
        assert r.f == best and (r.handle_hi, r.handle_lo) == (r.path[best - 1].hi, r.path[best - 1].lo)
    for r in trie.locate(paths, nodes, 5).collect():
        assert r.known == r.leaves == r.length and r.exit_hi is None
