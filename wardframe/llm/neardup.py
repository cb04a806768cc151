"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function orders the shingles; a document's sketch is its k least hashes.  Equal shingle sets are
one class before anything else.  Inverted lists over the retained values give the candidates: two sets with
a Jaccard similarity of ``percent`` share at least (``percent`` - ``SLACK``) % of their sketches, half at 85 and
45 % at 80 (they miss that with a chance of 9e-12 and 3e-11 at k = 64, and below 1e-8 from 50 on), so they share
``SHARED`` values among the rarest rest and the next ``SHARED`` values of each
(all of that part of a smaller sketch), and only those are listed; what many documents share makes no long list
unless the documents are alike, and a chance meeting of a few shingles makes no candidate.  The bottom-k sketch of the
union estimates the similarity, and links are confirmed on the full sets.

Before lists are compared, classes that cannot link at all leave them: a linked set has at least ``percent`` % of its
shingles in another listed set, so a set with more shingles that no other listed set holds has no partner (exact, on
full sets).  A list is not expanded into pairs: its members are compared with a pivot, first the member that shares most of
its own shingles with others (the text that near copies were made from), and only members that are then in different
components are compared further, the largest component of a list never with itself.  For that last comparison lists with
the same leader (the member of least hash) are one group, in which a member meets only sizes that can be similar enough
given the shingles that it shares with any other set, and similarity is judged exactly on the sets' differences from what most
of the group hold.  The tests of a group still grow with the square of its members outside the largest component.

Defined cases: null or wordless texts have an empty set and no links; fewer words than a shingle make one
shingle; repeated rows are one class; rows with a null id link others but never name a component while
another id is there; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.registry import query, table
from wardframe.llm.text import hashes_of_words, window_hashes, word_hashes
from wardframe.sources.scratch import erased, materialised, written

SHINGLE, SKETCH, PERCENT, PIVOT_ROUNDS = 5, 64, 85, 2
#: points by which the shared part of two sketches may stay below the similarity
SLACK = 35
#: values that a candidate pair shares in its lists; each sketch is listed that much beyond what a pair need not share
SHARED = 8
#: bits of the filter before a join, 4 MB that every task is sent
FILTER_BITS = 1 << 25
#: bytes of text of which a task holds the sets at a time
PART_BYTES = 1 << 17
#: list entries that a task sorts at a time, and that one slot of their values gets on average
PART_VALUES, SLOT_VALUES = 1 << 20, 1 << 20


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = word_hashes(text, lower=True)
    return shingle_sets(words, np.array([0, len(words)]), width)[0]


def shingle_sets(words: np.ndarray, edges: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of several texts, one after another, and where each text's begin.

    Text i has the word hashes ``words[edges[i]:edges[i + 1]]``, and ``words`` has no others.
    """
    counts = np.diff(edges)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.cumsum(sizes)
    found = np.empty(int(sizes.sum()), np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    found[np.repeat(counts >= width, sizes)] = window_hashes(words, width)[text[:len(text) - width + 1] == text[width - 1:]] if len(words) >= width else 0
    for i in np.flatnonzero((counts > 0) & (counts < width)):  # too short for a shingle: all words are one
        found[ends[i] - 1] = window_hashes(words[edges[i]:edges[i + 1]], int(counts[i]))[0]
    found = found.view(np.int64)
    begin = ends - sizes
    for a, b in zip(begin.tolist(), ends.tolist(), strict=True):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    new[begin[sizes > 0]] = True
    return found[new], np.concatenate([[0], np.cumsum(new)])[np.concatenate([begin, [len(found)]])]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of at most ``PART_BYTES`` of text (or one row), with the bytes of their texts and where each begins."""
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    _, places, data = texts.buffers()
    edges = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + PART_BYTES, "right")) - 1)
        yield batch.slice(at, end - at), raw[edges[at]:edges[end]], edges[at:end + 1] - edges[at]
        at = end


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values))


def _digests(values: np.ndarray, edges: np.ndarray) -> list[str]:
    ends = edges.tolist()
    return [hashlib.md5(values[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, edges in _parts(batch):
            words, words_at = hashes_of_words(raw, edges, lower=True)
            sets, at = shingle_sets(words, words_at)
            # equal up to case and white space: case beyond ASCII is no shingle's matter
            alike = _digests(words, words_at)
            odd = raw >= 0xC4  # up to U+00FF only A-Z and U+00C0 to U+00DE change
            odd[:-1] |= (raw[:-1] == 0xC3) & (raw[1:] < 0x9F)
            for i in np.flatnonzero(np.diff(np.searchsorted(np.flatnonzero(odd), edges))):
                body = raw[edges[i]:edges[i + 1]].tobytes()
                low = body.decode("utf-8").lower()
                if low.encode("utf-8") != body.lower():
                    alike[i] = hashlib.md5(word_hashes(low)).hexdigest()
            n = np.diff(at)
            kept = np.minimum(n, SKETCH)
            sketch = _lists(sets[np.arange(len(sets)) - np.repeat(at[:-1], n) < SKETCH], np.concatenate([[0], np.cumsum(kept)]))
            cls = pa.array(_digests(sets, at), pa.string(), mask=n == 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("tkey"), pa.array(np.diff(words_at)), pa.array(alike, pa.string()), pa.array(n), cls, sketch],
                ["key", "tkey", "words", "alike", "n", "cls", "sketch"])


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, edges in _parts(batch):
            yield pa.RecordBatch.from_arrays([part.column("cid"), _lists(*shingle_sets(*hashes_of_words(raw, edges, lower=True)))], ["cid", "full"])


def _merged(values: np.ndarray, counts: np.ndarray, cids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, how often each comes and one of its cids."""
    order = np.argsort(values)
    values, counts, cids = values[order], counts[order], cids[order]
    new = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[new], np.add.reduceat(counts, new), cids[new]


def holders(lists: DataFrame, column: str, entries: int) -> DataFrame:
    """value, often: what more than one cid holds; and without a value, cid, lone: how many values it alone holds, in parts to be summed.

    ``lists`` has cid and an array of distinct longs, ``entries`` in all.  Values are counted in each task first and dealt by value
    into slots, many to a row; a value that all hold is one entry of each part of a task.
    """
    slots = max(int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entries // SLOT_VALUES))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            array = batch.column(column)
            ends, at = np.concatenate([[0], np.cumsum(array.value_lengths().to_numpy(zero_copy_only=False))]), 0
            flat, owners = array.flatten().to_numpy(), batch.column("cid").to_numpy()
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(ends, ends[at] + PART_VALUES, "right")) - 1)
                if ends[end] > ends[at]:
                    values, counts, cids = _merged(flat[ends[at]:ends[end]], np.ones(ends[end] - ends[at], np.int64), np.repeat(owners[at:end], np.diff(ends[at:end + 1])))
                    slot = (values.view(np.uint64) % np.uint64(slots)).astype(np.int32)
                    order = np.argsort(slot, kind="stable")
                    sizes = np.bincount(slot, minlength=slots)
                    here = np.flatnonzero(sizes)
                    edges = np.concatenate([[0], np.cumsum(sizes[here])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(here.astype(np.int32)), *[_lists(v[order], edges) for v in (values, counts, cids)]], ["slot", "values", "counts", "cids"])
                at = end

    def counted(table: pa.Table) -> pa.Table:
        values, counts, cids = _merged(*[pc.list_flatten(table.column(c)).to_numpy() for c in ("values", "counts", "cids")])
        many = counts > 1
        lone, times = np.unique(cids[~many], return_counts=True)
        none = pa.nulls(len(lone), pa.int64()), pa.nulls(int(many.sum()), pa.int64())
        parts = [(pa.array(values[many]), none[0]), (pa.array(counts[many]), none[0]), (none[1], pa.array(lone)), (none[1], pa.array(times))]
        return pa.Table.from_arrays([pa.chunked_array(p, pa.int64()) for p in parts], ["value", "often", "cid", "lone"])

    dealt_out = lists.select("cid", column).mapInArrow(dealt, "slot int, values array<long>, counts array<long>, cids array<long>")
    return dealt_out.groupBy("slot").applyInArrow(counted, "value long, often long, cid long, lone long")


def likely(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is in ``wanted``, and few others: a filter before a join, by one bit for each of ``FILTER_BITS`` hashes."""
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    byte = F.conv(F.hex(F.expr("substring(bits, int(bit div 8) + 1, 1)")), 16, 10).cast("int")
    marked = rows.withColumn("bucket", F.bitmap_bucket_number(place)).withColumn("bit", F.bitmap_bit_position(place)).join(F.broadcast(bits), "bucket")
    return marked.where(F.getbit(byte, F.expr("int(bit % 8)")) == 1).select(*rows.columns)


def components(links: DataFrame) -> DataFrame:
    """node, root (its least reachable node) for every node of ``links`` (a, b)."""
    edges = materialised(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialised(large, "links")
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lows.select("u", F.col("m").alias("v")))
        edges = materialised(small.where("u <> v").distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def judged(docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """key, tkey (digest of the text), words, alike (digest up to case and white space), n, component_id: one row per document."""
    if not 50 <= percent <= 100:
        raise ValueError("the sketch demand holds for 50 to 100 percent")
    body = docs.select(F.col(key).cast("long").alias("key"), F.md5(F.col(text)).alias("tkey"), F.col(text).alias("text"))
    rows = materialised(body.mapInArrow(_sketched, "key long, tkey string, words long, alike string, n long, cls string, sketch array<long>"), "sketches")
    grouped = rows.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min("key").alias("least"), F.min("tkey").alias("tkey"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialised(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")

    # values that one class holds are the rarest of its sketch: they count in what need not be shared, and only the others are listed
    size = classes.agg(F.sum(F.least("n", F.lit(SKETCH))).alias("kept"), F.sum("n").alias("all")).first()
    often, often_folder = written(holders(classes, "sketch", size["kept"] or 0), "often")
    demand = f"greatest(1, k * {percent - SLACK} div 100)"
    need = f"int(least({SHARED}, {demand}))"
    # only classes with enough values that others hold come to be listed; the values of the rest do not move
    lone = often.where("value IS NULL").groupBy("cid").agg(F.sum("lone").alias("lone"))
    some = classes.select("cid", "n", "sketch", F.size("sketch").alias("k")).join(lone, "cid", "left").where(f"k - coalesce(lone, 0) - {demand} + {need} > 0")
    shared = some.select("cid", "n", "k", F.explode("sketch").alias("value")).join(often.where("value IS NOT NULL").select("value", "often").hint("shuffle_hash"), "value").groupBy(
        "cid", "n", "k").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("s"))  # at most k entries
    listed = materialised(shared.select(
        "cid", "n", F.expr(need).alias("need"), F.explode(F.expr(f"slice(s, 1, greatest(0, int(size(s) - {demand} + {need})))")).alias("e")).select(
        F.col("e.value").alias("value"), "cid", "n", "need"), "lists")

    erased(docs.sparkSession, often_folder)
    every_set: list[tuple[DataFrame, str]] = []

    def sets() -> DataFrame:
        """cid and full set of the listed classes, computed once from one text each."""
        if not every_set:
            wanted = listed.select("cid").distinct().join(classes.select("cid", "tkey"), "cid")
            # a class has one text here, so its copies are where the join has brought them: texts move once, and few that are not wanted
            texts = likely(body.where(F.col("tkey").isNotNull()), wanted, "tkey").join(wanted.hint("shuffle_hash"), "tkey").groupBy("tkey", "cid").agg(F.first("text").alias("text"))
            every_set.append(written(texts.mapInArrow(_full, "cid long, full array<long>"), "sets"))
        return every_set[0][0]

    # a shingle of no other listed class cannot be in an intersection; sets with too many of those have no partner
    alone = holders(sets(), "full", size["all"] or 0).where("value IS NULL").groupBy("cid").agg(F.sum("lone").alias("alone"))
    able = sets().select("cid", F.size("full").alias("size")).join(alone, "cid", "left").withColumn("common", F.col("size") - F.coalesce("alone", F.lit(0))).where(
        100 * F.col("common") >= percent * F.col("size"))
    able = able.select("cid", "common", (F.col("common") / F.col("size")).alias("central"))
    linkable = materialised(listed.join(able, "cid"), "linkable")

    def possible(na: str, ca: str, nb: str, cb: str) -> F.Column:
        """Whether sets of n shingles, c of them in any other set, can be as similar as asked: they share at most the lesser c."""
        most = F.least(ca, cb)
        return 100 * most >= percent * (F.col(na) + F.col(nb) - most)

    def step(n: F.Column) -> F.Column:
        """The size class of n shingles, in steps of 2 %."""
        return F.floor(F.log(n.cast("double")) / math.log(1.02))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links (a, b) among distinct candidate pairs."""
        sk = classes.select("cid", "sketch")
        near = pairs.join(sk.toDF("a", "sa"), "a").join(sk.toDF("b", "sb"), "b")
        union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, F.greatest(F.lit(1), F.least(F.size("sa"), F.size("sb"))))
        both = F.array_intersect("sa", "sb")  # what the union's sketch shares is part of it
        near = near.where(100 * F.size(both) >= (percent - SLACK) * F.least(F.size("sa"), F.size("sb")))
        near = near.where(100 * F.size(F.array_intersect(union, both)) >= (percent - SLACK) * F.size(union)).select("a", "b")
        joined = near.join(sets().toDF("a", "fa"), "a").join(sets().toDF("b", "fb"), "b")
        inter = F.size(F.array_intersect("fa", "fb"))
        return materialised(joined.where(100 * inter >= percent * (F.size("fa") + F.size("fb") - inter)).select("a", "b"), "confirmed")

    def sized(pairs: DataFrame) -> DataFrame:
        """Pairs of like sizes that meet in enough lists; a pair comes at most once from each list."""
        met = pairs.where(possible("na", "ca", "nb", "cb")).where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("ka", "kb").alias("need"))
        return met.groupBy("a", "b").agg(F.count("*").alias("met"), F.max("need").alias("need")).where("met >= need").select("a", "b")

    links, roots, tried = None, None, None
    for turn in range(PIVOT_ROUNDS + 1):
        here = linkable if roots is None else linkable.join(roots, F.col("cid") == F.col("node"), "left").drop("node")
        here = here.withColumn("root", F.coalesce("root", "cid") if roots is not None else F.col("cid"))
        sizes = here.groupBy("value", "root").agg(F.count("*").alias("m"), F.max("central").alias("central"))
        top = sizes.groupBy("value").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("m", "central", "root")).alias("top")).where("roots > 1")
        here = here.join(top, "value")
        if turn < PIVOT_ROUNDS:  # everyone meets one member of the list's largest component
            pivots = here.where("root = top").groupBy("value").agg(F.min_by(F.struct("cid", "n", "need", "root", "common"), F.xxhash64("cid", F.lit(turn))).alias("p"))
            pairs = here.join(pivots, "value").where("root <> p.root").select(
                F.col("cid").alias("a"), F.col("n").alias("na"), F.col("need").alias("ka"), F.col("common").alias("ca"),
                F.col("p.cid").alias("b"), F.col("p.n").alias("nb"), F.col("p.need").alias("kb"), F.col("p.common").alias("cb"))
            pairs = sized(pairs)
        else:
            # lists with one leader are one group, so that two members of many like lists meet about once
            leaders = here.groupBy("value").agg(F.min_by("cid", F.xxhash64("cid")).alias("leader"))
            members = materialised(here.join(leaders, "value").groupBy("cid", "n", "need", "common", "root").agg(
                F.collect_list("value").alias("shared"), F.collect_set("leader").alias("leaders")).select("*", F.explode("leaders").alias("leader")).drop("leaders"), "members")
            largest = members.groupBy("leader", "root").agg(F.count("*").alias("m")).groupBy("leader").agg(F.max_by("root", F.struct("m", "root")).alias("top"), F.sum("m").alias("size"))
            # a set is held by its difference from what most of its group hold: the sets of a pair differ as their differences do
            whole = members.select("leader", "cid").join(sets(), "cid")
            held = whole.select("leader", F.explode("full").alias("v")).groupBy("leader", "v").agg(F.count("*").alias("holders"))
            usual = held.join(largest.select("leader", "size"), "leader").where("2 * holders > size").groupBy("leader").agg(F.collect_list("v").alias("usual"))  # at most two mean sets
            apart = whole.join(usual, "leader", "left").withColumn("usual", F.coalesce("usual", F.array().cast("array<long>"))).select(
                "leader", "cid", F.concat(F.array_except("full", "usual"), F.array_except("usual", "full")).alias("apart"))
            members = materialised(members.join(largest.drop("size"), "leader").join(apart, ["leader", "cid"]), "apart")
            # of two members outside the largest component each pair once; a member meets only the sizes that its shared shingles allow
            most = (100 + percent) * F.col("common") / percent - F.col("n")
            rest = members.where("root <> top").select(
                "leader", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("need").alias("kb"), F.col("root").alias("rb"), F.col("common").alias("cb"),
                F.col("shared").alias("sb"), F.col("apart").alias("apb"), F.explode(F.sequence(step(F.col("n") * percent / 100) - 1, step(most) + 1)).alias("size"))
            met = F.size(F.array_intersect("shared", "sb")) >= F.least("need", "kb")
            inter = F.expr("(n + nb - size(apart) - size(apb) + 2 * size(array_intersect(apart, apb))) div 2")
            alike = 100 * inter >= percent * (F.col("n") + F.col("nb") - inter)
            pairs = members.withColumn("size", step(F.col("n"))).join(rest, ["leader", "size"]).where("root <> rb AND (root = top OR cid < b)").where(
                possible("n", "common", "nb", "cb") & alike & met).select(F.least("cid", "b").alias("a"), F.greatest("cid", "b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialised(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = confirmed(pairs)
        links = found if links is None else links.unionByName(found)
        roots = components(links)

    grouped = classes.select("cls", "cid", "least").join(roots, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    named = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("cls", "component_id")
    out = rows.drop("sketch").join(named, "cls", "left").withColumn("component_id", F.when(F.col("cls").isNull(), F.col("key")).otherwise(F.col("component_id")))
    for _, folder in every_set:
        erased(docs.sparkSession, folder)
    return out.select("key", "tkey", "words", "alike", "n", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id, kept: one row per document; ``percent`` is the least similarity of a link."""
    out = judged(docs, key, text, percent)
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows that stay: one per component, all rows with an empty set, with all their columns."""
    kept = materialised(docs.select("*", F.monotonically_increasing_id().alias("__row")), "docs")
    found = near_duplicates(kept.select(F.col("__row").alias("k"), F.col(text).alias("t")), "k", "t", percent)
    members = found.select("k", F.col("component_id").alias("c")).join(kept.select(F.col("__row").alias("k"), F.col(key).alias("key")), "k")
    first = members.groupBy("c").agg(F.min_by("k", F.struct(F.col("key").isNull(), F.col("key"), F.col("k"))).alias("__keep")).select("__keep")
    return kept.join(first, F.col("__row") == F.col("__keep"), "left_semi").select(*docs.columns)


@query("op6_bottom_k_components")
def op6(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))
