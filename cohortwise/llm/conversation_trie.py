"""Prefix trie of conversations: a z-fast trie whose handle table is a Spark table.

A key is the sequence of a conversation's turns, held as 128-bit digests of all its prefixes. A compacted node is a prefix after
which conversations part or one ends; its edge covers the depths (top, extent]. The table keeps each node under the digest of its
handle, the prefix at the two-fattest depth of its edge (that divisible by the highest power of two), and under its first turn
below its parent.

Keys are inserted in batches. All keys of a batch look for their exit node at once by fat binary search: each round probes one
handle per key, so the rounds are the bits of the greatest depth, and one more lookup finds the child into whose edge the key goes. Edges
are cut where keys leave them. The new parts of the keys grow branches: per prefix the smallest key and whether its keys part there come
from one aggregate, and the prefixes of one smallest key form a path, whose compacted nodes are read off in one row.

Totals of subtrees double their reach in each round (a node adds the totals of the nodes 1, 2, 4, ... levels below), along
compacted parents. Then edges are expanded into nodes. Keys, probes and prefixes are aggregated before they are dealt, joins
hold one row per digest on one side, so a first turn or a conversation that a third of all share is no task's own. A conversation is one row of
24 bytes a turn; texts stay where they are read. Digests of conversation ids take their ids as a sorted stream of chunks.

Defined results: a missing role or text is empty, a missing turn comes first, turns of equal number are ordered by the digest of role and
text, repeated rows are turns of their own. Rows without conv_id belong to no conversation. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import stage

#: A base conversation lends its first turns to those of its group; at most HEADS - 1 of them.
GROUP, HEADS = 5, 9
#: Shares of the keys in the first batches, by hash; the last batch holds the rest.
BATCHES = (64, 8)
#: Conversation ids of one chunk of a node's list.
CHUNK = 1 << 14

_STEP = "struct<hi:long,lo:long,upto:long>"
EMPTY = hashlib.sha256().hexdigest()


def turns(table: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each as the digest of role and text and the bytes of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    one = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    rows = table.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def rebuilt(table: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, turns): the first h turns of the group's base conversation, then the own turns after the first h."""
    own = turns(table)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    base = own.select(F.col("conv_id").alias("base_id"), F.col("turns").alias("base_turns"))
    rows = own.withColumns({"base_id": F.col("conv_id") - F.col("conv_id") % group, "h": h}).join(base, "base_id", "left")
    head = F.slice(F.coalesce("base_turns", F.array().cast("array<struct<digest:string,size:long>>")), F.lit(1), F.col("h"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("conv_id", F.concat(head, tail).alias("turns"))


def with_path(conversations: DataFrame) -> DataFrame:
    """(conv_id, length, path): the digest of each prefix, that of the whole last, and the bytes of its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = []
            for row in b.column("turns").to_pylist():
                state, path, upto = b"", [], 0
                for t in row:
                    state, upto = hashlib.blake2b(state + t["digest"].encode(), digest_size=16).digest(), upto + t["size"]
                    path.append({"hi": int.from_bytes(state[:8], "big", signed=True), "lo": int.from_bytes(state[8:], "big", signed=True), "upto": upto})
                paths.append(path)
            kind = pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int64()), ("upto", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array([len(p) for p in paths], pa.int32()), pa.array(paths, kind)],
                                             names=["conv_id", "length", "path"])
    return conversations.mapInArrow(run, f"conv_id long, length int, path array<{_STEP}>")


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides: the common leading bits of low and high, and one more of high."""
    bit = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bit), bit)


def _at(path: str, depth: Column, part: str) -> Column:
    return F.try_element_at(path, F.greatest(depth, F.lit(1)))[part]


def _nodes(df: DataFrame) -> DataFrame:
    """Rows of the handle table from (top, extent, path) with the path down to the extent."""
    handle = fattest(F.col("top"), F.col("extent"))
    return df.select(_at("path", F.col("extent"), "hi").alias("hi"), _at("path", F.col("extent"), "lo").alias("lo"), "top", "extent",
                     F.slice("path", F.lit(1), F.col("extent")).alias("path"),
                     _at("path", handle, "hi").alias("handle_hi"), _at("path", handle, "lo").alias("handle_lo"),
                     _at("path", F.col("top") + 1, "hi").alias("first_hi"), _at("path", F.col("top") + 1, "lo").alias("first_lo"))


def locate(keys: DataFrame, trie: DataFrame, rounds: int) -> DataFrame:
    """Each key with the depth of its deepest node on its path (known), and the node into whose edge it goes on, if any, with the depth where it leaves."""
    rows = keys.withColumns({"known": F.lit(0), "upto": F.col("length")})
    handles = trie.select(F.col("handle_hi").alias("probe_hi"), F.col("handle_lo").alias("probe_lo"), F.col("extent").alias("found"),
                          F.col("hi").alias("found_hi"), F.col("lo").alias("found_lo"))
    for _ in range(rounds):
        # searches that are over probe their own key, which deals them evenly; what they find is not looked at
        open_ = F.col("known") < F.col("upto")
        probe = F.when(open_, fattest(F.col("known"), F.greatest("upto", F.col("known") + 1))).otherwise(F.col("length"))
        rows = rows.withColumn("probe", probe).withColumns({
            "probe_hi": F.coalesce(_at("path", F.col("probe"), "hi"), F.col("conv_id")), "probe_lo": F.coalesce(_at("path", F.col("probe"), "lo"), F.col("conv_id"))})
        rows = rows.join(handles, ["probe_hi", "probe_lo"], "left")
        on_path = (F.coalesce(F.col("found") <= F.col("length"), F.lit(False)) & (_at("path", F.col("found"), "hi") == F.col("found_hi"))
                   & (_at("path", F.col("found"), "lo") == F.col("found_lo")))
        rows = rows.withColumns({"known": F.when(open_ & on_path, F.col("found")).otherwise(F.col("known")),
                                 "upto": F.when(open_ & ~on_path, F.col("probe") - 1).otherwise(F.col("upto"))})
        rows = rows.select("conv_id", "length", "path", "known", "upto")
    child = trie.select("first_hi", "first_lo", "extent", F.col("hi").alias("exit_hi"), F.col("lo").alias("exit_lo"), F.col("path").alias("exit_path"))
    below = F.col("known") < F.col("length")
    rows = rows.withColumns({"first_hi": F.when(below, _at("path", F.col("known") + 1, "hi")).otherwise(F.col("conv_id")),
                             "first_lo": F.when(below, _at("path", F.col("known") + 1, "lo")).otherwise(F.col("conv_id"))})
    rows = rows.join(child, ["first_hi", "first_lo"], "left")
    # prefixes that agree come first, so their number is the depth where the key leaves the edge
    agree = F.size(F.filter(F.sequence(F.col("known") + 1, F.least("extent", "length")),
                            lambda d: (F.element_at("path", d)["hi"] == F.element_at("exit_path", d)["hi"])
                            & (F.element_at("path", d)["lo"] == F.element_at("exit_path", d)["lo"])))
    inside = below & F.col("extent").isNotNull()
    return rows.select("conv_id", "length", "path", "known", F.when(inside, F.col("exit_hi")).alias("exit_hi"), F.when(inside, F.col("exit_lo")).alias("exit_lo"),
                       F.when(inside, F.col("known") + agree).otherwise(F.col("known")).alias("leaves"))


def _cut(trie: DataFrame, located: DataFrame) -> DataFrame:
    """The trie with its edges cut at the depths where keys leave or end inside them."""
    cuts = located.where("exit_hi IS NOT NULL").select(F.col("exit_hi").alias("hi"), F.col("exit_lo").alias("lo"), F.col("leaves").alias("cut")).distinct()
    cuts = cuts.groupBy("hi", "lo").agg(F.collect_list("cut").alias("cuts"))
    rows = trie.select("hi", "lo", "top", "extent", "path").join(cuts, ["hi", "lo"], "left")
    inner = F.filter(F.coalesce("cuts", F.array().cast("array<int>")), lambda c: (c > F.col("top")) & (c < F.col("extent")))
    marks = F.concat(F.array("top"), F.array_sort(inner), F.array("extent"))
    pieces = F.transform(F.sequence(F.lit(1), F.size("marks") - 1), lambda i: F.struct(
        F.element_at("marks", i).alias("top"), F.element_at("marks", i + 1).alias("extent")))
    return rows.withColumn("marks", marks).select("path", F.explode(pieces).alias("p")).select("p.top", "p.extent", "path")


def _grow(located: DataFrame) -> DataFrame:
    """Compacted nodes of the new parts of the keys, below the depths where they leave the trie."""
    fresh = located.where("leaves < length")
    depths = fresh.select("conv_id", "length", "path", F.explode(F.sequence(F.col("leaves") + 1, F.col("length"))).alias("depth"))
    rows = depths.select("conv_id", "depth", _at("path", F.col("depth"), "hi").alias("hi"), _at("path", F.col("depth"), "lo").alias("lo"),
                         (F.col("depth") == F.col("length")).cast("int").alias("ends"),
                         F.when(F.col("depth") < F.col("length"), F.try_element_at("path", F.col("depth") + 1)).alias("next"))
    sides = [f(f"next.{c}").alias(f"{name}_{c}") for name, f in (("min", F.min), ("max", F.max)) for c in ("hi", "lo")]
    prefixes = rows.groupBy("hi", "lo").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("ends").alias("ends"), *sides)
    parts = F.coalesce((F.col("min_hi") != F.col("max_hi")) | (F.col("min_lo") != F.col("max_lo")), F.lit(False))
    marked = prefixes.select("conv_id", "depth", F.when(parts | (F.col("ends") == 1), F.col("depth")).alias("mark"))
    # the prefixes of one smallest key follow each other; above them its path parts from that of a smaller key, at a node
    paths = marked.groupBy("conv_id").agg((F.min("depth") - 1).alias("from"), F.array_sort(F.collect_list("mark")).alias("marks"))
    pieces = F.transform(F.sequence(F.lit(1), F.size("marks") - 1), lambda i: F.struct(
        F.element_at("marks", i).alias("top"), F.element_at("marks", i + 1).alias("extent")))
    return (paths.withColumn("marks", F.concat(F.array("from"), "marks")).join(fresh.select("conv_id", "path"), "conv_id")
            .select("path", F.explode(pieces).alias("p")).select("p.top", "p.extent", "path"))


def insert(trie: DataFrame, batch: DataFrame, rounds: int) -> DataFrame:
    located = stage(locate(batch, trie, rounds), "trie-located")
    return stage(_nodes(_cut(trie, located).unionByName(_grow(located))), "trie-nodes")


def build(keys: DataFrame) -> DataFrame:
    """The compacted nodes, but for the root, of distinct keys (conv_id, length, path)."""
    keys = keys.where("length > 0")
    longest = keys.agg(F.max("length")).first()[0] or 0
    rounds = int(longest).bit_length()
    trie = _nodes(keys.sparkSession.createDataFrame([], f"top int, extent int, path array<{_STEP}>"))
    share = lambda k: F.pmod(F.xxhash64("conv_id"), F.lit(k)) == 0
    left = F.lit(True)
    for k in BATCHES:
        trie = insert(trie, keys.where(left & share(k)), rounds)
        left = left & ~share(k)
    return insert(trie, keys.where(left), rounds)


# --- members and totals

def ends(members: DataFrame) -> DataFrame:
    """(hi, lo) of each key with the number of its conversations, the smallest, and the SHA-256 of all ids in order.

    Ids are sorted over all partitions, written as chunks, and the chunks of a key are digested as a stream.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        def out():
            return pa.RecordBatch.from_pydict({"hi": [key[0]], "lo": [key[1]], "first": [ids[0]], "n": [len(ids)], "text": [",".join(map(str, ids)).encode()]})
        for b in batches:
            for hi, lo, c in zip(*(b.column(k).to_pylist() for k in ("hi", "lo", "conv_id"))):
                if ids and ((hi, lo) != key or len(ids) >= CHUNK):
                    yield out()
                    ids = []
                key = (hi, lo)
                ids.append(c)
        if ids:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, n, first = None, None, 0, None
        rows = {c: [] for c in ("hi", "lo", "n_here", "first", "ends_sha256")}
        def close():
            for c, v in zip(rows, (*key, n, first, state.hexdigest())):
                rows[c].append(v)
        for b in batches:
            for hi, lo, low, many, text in zip(*(b.column(k).to_pylist() for k in ("hi", "lo", "first", "n", "text"))):
                if (hi, lo) != key:
                    if key is not None:
                        close()
                    key, state, n, first = (hi, lo), hashlib.sha256(), 0, low
                else:
                    state.update(b",")
                state.update(text)
                n += many
            if len(rows["hi"]) > 1 << 14:
                yield pa.RecordBatch.from_pydict(rows)
                rows = {c: [] for c in rows}
        if key is not None:
            close()
            yield pa.RecordBatch.from_pydict(rows)

    ids = members.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions("hi", "lo", "conv_id")
    chunked = ids.mapInArrow(chunks, "hi long, lo long, first long, n long, text binary")
    dealt = chunked.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first")
    return dealt.mapInArrow(digests, "hi long, lo long, n_here long, first long, ends_sha256 string")


_SUMS = ("n", "whole", "sizes", "leaves")


def totals(trie: DataFrame, ended: DataFrame) -> DataFrame:
    """Nodes with the sums over their subtrees: conversations, bytes of those conversations, bytes of edges, leaves; children; smallest conversation."""
    up, upto = F.col("top") > 0, lambda depth: _at("path", F.col(depth), "upto")
    nodes = trie.join(ended, ["hi", "lo"], "left").select(
        "hi", "lo", "top", "extent", "path", "n_here", "ends_sha256", F.when(up, upto("top")).otherwise(0).alias("above"), upto("extent").alias("bytes"),
        F.col("first").alias("low"), F.when(up, _at("path", F.col("top"), "hi")).alias("up_hi"), F.when(up, _at("path", F.col("top"), "lo")).alias("up_lo"))
    nodes = stage(nodes, "trie-ended")
    below = nodes.where("up_hi IS NOT NULL").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count("*").alias("below"))
    n = F.coalesce("n_here", F.lit(0))
    state = nodes.join(below, ["hi", "lo"], "left").select(
        "hi", "lo", n.alias("n"), (n * F.col("bytes")).alias("whole"), (F.col("bytes") - F.col("above")).alias("sizes"),
        F.col("below").isNull().cast("long").alias("leaves"), F.coalesce("below", F.lit(0)).alias("below"), "low", "up_hi", "up_lo")
    while True:
        state = stage(state, "trie-sums")
        reaching = state.where("up_hi IS NOT NULL")
        if reaching.isEmpty():
            break
        more = reaching.groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(*[F.sum(c).alias(f"more_{c}") for c in _SUMS], F.min("low").alias("more_low"))
        sums = state.join(more, ["hi", "lo"], "left").select(
            "hi", "lo", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in _SUMS], "below", F.least("low", "more_low").alias("low"),
            # a node without an ancestor that far finds itself, and so none again
            F.coalesce("up_hi", "hi").alias("at_hi"), F.coalesce("up_lo", "lo").alias("at_lo"))
        jump = state.select(F.col("hi").alias("at_hi"), F.col("lo").alias("at_lo"), "up_hi", "up_lo")
        state = sums.join(jump, ["at_hi", "at_lo"], "left").drop("at_hi", "at_lo")
    return stage(nodes.drop("low").join(state.select("hi", "lo", *_SUMS, "below", F.col("low").alias("conv_id")), ["hi", "lo"]), "trie-totals")


_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expand(nodes: DataFrame, ended: DataFrame) -> DataFrame:
    """One row per prefix: edges unfold into their depths, and the root."""
    spark = nodes.sparkSession
    tops = nodes.where("top = 0")
    one = tops.agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.sum("whole").alias("whole"), F.sum("sizes").alias("sizes"),
                   F.sum("leaves").alias("leaves"), F.count("*").alias("below")).first()
    bare = ended.where("hi = 0 AND lo = 0").first()  # conversations without turns
    n = (one.n or 0) + (bare.n_here if bare else 0)
    least = min([x for x in (one.conv_id, bare.first if bare else None) if x is not None], default=None)
    root = [(least, 0, None, n, one.below, one.leaves or 1, (one.whole or 0) - (one.sizes or 0), bare.ends_sha256 if bare else EMPTY)] if n else []
    root = spark.createDataFrame(root, "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    parent = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("up_id"))
    rows = nodes.where("up_hi IS NOT NULL").join(parent, ["up_hi", "up_lo"], "left").select(*nodes.columns, "up_id").unionByName(
        tops.select(*nodes.columns, F.lit(least).cast("long").alias("up_id")))
    before = lambda d: F.when(d > 1, F.element_at("path", F.greatest(d - 1, F.lit(1)))["upto"]).otherwise(0)
    steps = F.transform(F.sequence(F.col("top") + 1, F.col("extent")), lambda d: F.struct(d.alias("depth"), before(d).alias("before")))
    rows = rows.select("*", F.explode(steps).alias("s")).select("*", "s.depth", "s.before")
    last, first = F.col("depth") == F.col("extent"), F.col("depth") == F.col("top") + 1
    rows = rows.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.when(first, F.col("up_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("below")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("whole") - F.col("n") * F.col("before") - F.col("sizes") + F.col("before") - F.col("above")).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256"))
    return rows.select(*_OUT).unionByName(root)


def nodes(table: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """All prefixes of the rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = stage(with_path(rebuilt(table, group, heads)), "trie-paths")
    zero = F.lit(0).cast("long")
    whole = lambda c: F.when(F.col("length") > 0, _at("path", F.col("length"), c)).otherwise(zero).alias(c)
    ended = stage(ends(paths.select(whole("hi"), whole("lo"), "conv_id")), "trie-ends")
    keys = stage(paths.join(ended.select(F.col("first").alias("conv_id")), "conv_id", "left_semi"), "trie-keys")
    return expand(totals(build(keys), ended), ended)
