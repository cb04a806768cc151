"""Each operator against a plain version of its contract, on planted rows and on the driver's small tables."""

import hashlib
import os
import re
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wardframe.llm import chat, mixing, neardup, packing, pages, private, quality, substrings, suffixes, topk

FOLDER = "/root/testdata/sf0.001"
have_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row long, words string"


def words_from(seed, n, size=5000):
    return [f"w{i}" for i in np.random.default_rng(seed).integers(0, size, n)]


def planted():
    """Copies, near copies, shared passages, nulls, empties, long texts, ties, repeated rows."""
    base, passage = words_from(1, 400), words_from(2, 120)
    texts = [" ".join(base)] * 3
    for i in range(6):  # near copies
        edited = list(base)
        edited[40 * i + 7] = f"edit{i}"
        texts.append(" ".join(edited))
    for i in range(5):  # a passage that other texts share
        texts.append(" ".join(words_from(10 + i, 60 + 30 * i) + passage + words_from(20 + i, 80)))
    texts += [None, "", "  \n ", "one two", "one two", " ".join(words_from(3, 20000)), "ab " * 300, " ".join(words_from(4, 60) * 3), "ünï çödé " * 5, "A B c d e f"]
    rows = [(i if i != 4 else None, t, "en", [None, "a", "b", "b", "hot"][i % 5], 0, "x", 1, "y") for i, t in enumerate(texts)]
    return rows + [rows[-1], rows[9]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(planted(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def inputs(spark, docs):
    yield docs
    if os.path.isdir(FOLDER):
        yield spark.read.parquet(f"{FOLDER}/documents.parquet")


def pulled(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_repeated_bytes(spark, docs, nothing):
    for frame in inputs(spark, docs):
        rows = [(r["doc_id"], (r["text"] or "").encode()) for r in frame.collect()]
        seen = Counter(raw[i:i + 400] for _, raw in rows for i in range(len(raw) - 399))
        want = []
        for doc, raw in rows:
            gone = np.zeros(len(raw), bool)
            for i in range(len(raw) - 399):
                if seen[raw[i:i + 400]] > 1:
                    gone[i:i + 400] = True
            kept = bytes(b for b, g in zip(raw, gone) if not g)
            runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
            want.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
        got = suffixes.remove_repeats(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert pulled(got) == sorted(want, key=repr)
        assert any(w[2] for w in want)
    assert suffixes.remove_repeats(nothing).collect() == []


def test_repeated_passages(spark, docs, nothing):
    for frame in inputs(spark, docs):
        rows = [((1 << 63) - 1 if r["doc_id"] is None else r["doc_id"], r["doc_id"], WORD.findall(r["text"] or "")) for r in frame.collect()]
        first = {}
        for order, _, w in rows:
            for i in range(len(w) - 49):
                k = tuple(w[i:i + 50])
                first[k] = min(first.get(k, order), order)
        want = []
        for order, doc, w in rows:
            gone = [False] * len(w)
            for i in range(len(w) - 49):
                if first[tuple(w[i:i + 50])] < order:
                    gone[i:i + 50] = [True] * 50
            kept = " ".join(x for x, g in zip(w, gone) if not g)
            want.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
        got = substrings.remove_passages(frame).select("doc_id", "n_words", "n_removed", "kept_sha256")
        assert pulled(got) == sorted(want, key=repr)
        assert any(w[2] for w in want)
    assert substrings.remove_passages(nothing).collect() == []


def test_near_duplicates(spark, docs, nothing):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for frame in inputs(spark, docs):
        rows, sets = [], []
        for r in frame.collect():
            w = WORD.findall((r["text"] or "").translate(lower))
            rows.append(r["doc_id"])
            sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
        parent = list(range(len(rows)))

        def root(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(rows)):
            for j in range(i):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    parent[root(i)] = root(j)
        least = defaultdict(list)
        for i, doc in enumerate(rows):
            least[root(i)].append(doc)
        want = []
        for i, doc in enumerate(rows):
            ids = [d for d in least[root(i)] if d is not None]
            c = min(ids) if ids else None
            want.append((doc, len(sets[i]), c, doc == c))
        assert pulled(neardup.near_duplicates(frame)) == sorted(want, key=repr)
        assert frame.count() > neardup.one_of_each(frame).count() >= len({root(i) for i in range(len(rows)) if sets[i]})
    assert neardup.near_duplicates(nothing).collect() == []


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 4]) for i in range(160)]
    rows += [(200, None), (250, [1.0, float("nan")] + [0.0] * 4), (300, [0.0] * 6), (50, rows[50][1]), (350, [1.0, 2.0]), (None, rows[3][1]), (400, [])]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "vec_id long, embedding array<double>, row string, score int")
    fine = [(n, i, [int(np.floor(256 * x)) for x in v]) for n, (i, v) in enumerate(rows) if v and all(np.isfinite(v))]
    want = []
    for n, i, v in fine:
        if i is not None and i % 50 == 0:
            others = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m) for m, j, w in fine if m != n and len(w) == len(v))[:5]
            want += [(i, rank, None if none else j, -s) for rank, (s, none, j, _) in enumerate(others, 1)]
    assert pulled(topk.top_k(df, F.col("id") % 50 == 0)) == sorted(want, key=repr)
    assert topk.top_k(df.limit(0), F.col("id") % 50 == 0).collect() == []


def test_mix(spark, docs, nothing):
    for frame in inputs(spark, docs):
        rows, targets, placed = mixing.mixture(frame)
        goal = {r["source"]: r for r in targets.collect()}
        names = sorted((s for s in goal if s is not None), key=lambda s: s.encode()) + ([None] if None in goal else [])
        weight = {s: float(i % 3 + 1) for i, s in enumerate(names)}
        total, capped, level = sum(g["source_size"] for g in goal.values()), set(), 0.0
        while True:
            level = (total - sum(3 * goal[s]["source_size"] for s in capped)) / sum(weight[s] for s in names if s not in capped)
            more = {s for s in names if s not in capped and weight[s] * level > 3 * goal[s]["source_size"]}
            if not more:
                break
            capped |= more
        for s in names:
            assert goal[s]["target"] == pytest.approx(min(3 * goal[s]["source_size"], weight[s] * level))
        drawn = placed.groupBy("row").agg(F.sum("words").alias("taken"))
        joined = rows.join(drawn, "row", "left").fillna({"taken": 0}).collect()
        by_source = Counter()
        for r in joined:
            assert r["taken"] <= 3 * r["size"]
            by_source[r["source"]] += r["taken"]
        for s in names:
            assert abs(by_source[s] - goal[s]["target"]) <= mixing.BLOCK_WORDS
        again = mixing.mixture(frame.repartition(5))[2].groupBy("key").agg(F.sum("words"))
        assert pulled(again) == pulled(placed.groupBy("key").agg(F.sum("words")))
        assert placed.count() == placed.select("row", "block", "pass").distinct().count()
    assert mixing.mixed_documents(nothing).collect() == []
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([((False, f"s{i}"), 100 * i + 3) for i in range(9)], "sid struct<n:boolean,s:string>, quota long")
    got = mixing.split_quotas(quotas, 37).collect()
    by_source, by_shard = Counter(), Counter()
    for r in got:
        by_source[r["sid"]["s"]] += r["quota"]
        by_shard[r["shard"]] += r["quota"]
    assert by_source == {f"s{i}": 100 * i + 3 for i in range(9)}
    assert len(by_shard) == 37 and max(by_shard.values()) - min(by_shard.values()) <= 6


def _luhn(digits):
    return sum((d if i % 2 == 0 else d * 2 - 9 * (d > 4)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pseudonyms(spark, nothing):
    cards = ["4111111111111111", "4111 1111 1111 1111", "5500-0055-5555-5559"]
    text = f"{cards[0]} a {cards[1]} b {cards[2]} c 4111111111111112 on 2021-02-28, 2021-02-30 or 25/12/1999; +1 (269) 555-3296 and 078-05-1120 at 10.0.0.1 or 999.1.1.1 Bob.x@mail.example.com end 12345"
    df = spark.createDataFrame([(1, text), (2, f"x {cards[0]} 2021-02-28 +1 (269) 555-3296"), (3, None), (4, "")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in private.pseudonymise(df).collect()}
    one = out[1]
    assert out[3] is None and out[4] == ""
    assert not any(v in one for v in [*cards, "2021-02-28", "25/12/1999", "555-3296", "078-05-1120", "10.0.0.1", "Bob"])
    assert "4111111111111112" in one and "2021-02-30" in one and "999.1.1.1" in one and one.endswith("end 12345")
    found = re.match(r"(\d{16}) a (\d{4} \d{4} \d{4} \d{4}) b (\d{4}-\d{4}-\d{4}-\d{4}) c .* on (\S+), .* or (\d\d/\d\d/\d{4}); (\+1 \(\d{3}\) \d{3}-\d{4}) and (\d{3}-\d\d-\d{4}) at (\S+) or", one)
    assert found and all(_luhn(re.sub(r"\D", "", found[i])) for i in (1, 2, 3))
    assert found[1] == found[2].replace(" ", "") and date.fromisoformat(found[4])
    assert out[2] == f"x {found[1]} {found[4]} {found[6]}"  # linked across documents
    assert private.pseudonymise(nothing).collect() == []


def test_feistel_is_a_permutation(spark):
    days = spark.range(0, 146097, 37).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert private.pseudonymise(days).distinct().count() == days.count()
    numbers = spark.range(3000).select(F.concat(F.lit("+1 "), F.lpad((F.col("id") + 200_000_0000).cast("string"), 10, "0")).alias("text"))
    numbers = numbers.select(F.regexp_replace("text", r"(\d{3})(\d{3})(\d{4})$", r"(\$1) \$2-\$3".replace("\\$", "$")).alias("text"))
    assert private.pseudonymise(numbers).distinct().count() == 3000


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\b ### x </turn>\n### user: y"), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, None, None), (3, 1, "a:b\\", ""),
            (4, 0, "user", "hi"), (4, 1, "assistant", "other"), (None, 0, "user", "z\n"), (5, 0, "assistant", "é" * 3000), (5, 0, "assistant", "é" * 3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int")
    nodes, leaves = chat.prefix_tree(df)
    got = {r["conv"]: r for r in chat.outputs(nodes, leaves).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        assert chat.read_back(got[conv]["output"]) == [(r, t) for _, r, t in mine]
        assert [chat.unescaped(got[conv]["output"][s["a"]:s["b"]]) for s in got[conv]["loss"]] == [t for _, r, t in mine if r == "assistant"]
    tree = sorted(nodes.collect(), key=lambda n: n["start"])
    assert len(tree) == len({n["node"] for n in tree}) == 8
    at = 0
    for n in tree:  # one gapless sequence, parents before children, positions go on from the ancestors
        assert n["start"] == at and n["end"] == at + len(n["output"])
        assert sum(a["end"] - a["start"] for a in n["ancestors"]) == n["position"] and all(a["end"] <= n["start"] for a in n["ancestors"])
        at = n["end"]
    assert chat.prefix_tree(df.limit(0))[0].collect() == []


def test_packing(spark, docs, nothing):
    for frame in inputs(spark, docs):
        want = Counter((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in frame.collect())
        got = packing.pack(frame, capacity=512).collect()
        per_doc, bins = Counter(), defaultdict(list)
        for r in got:
            per_doc[r["doc_id"]] += r["n_words"]
            if r["bin"] is not None:
                bins[r["bin"]].append((r["place"], r["n_words"], r["doc_id"]))
        totals = Counter()
        for (doc, n), times in want.items():
            totals[doc] += n * times
        assert per_doc == totals
        for parts in bins.values():
            at = 0
            for place, n, _ in sorted(parts):
                assert place == at
                at += n
            assert at <= 512
            source = {r["doc_id"]: r["source"] for r in frame.collect()} if len(parts) > 1 else {}
            assert len(parts) == 1 or len({source[d] for _, _, d in parts}) == len(parts)
    assert packing.pack(nothing).collect() == []


def test_best_fit_takes_the_tightest():
    rng = np.random.default_rng(9)
    sizes = sorted(rng.integers(1, 60, 300).tolist(), reverse=True)
    sources, clusters = rng.integers(0, 9, 300).tolist(), rng.integers(0, 80, 300).tolist()
    bins, want = [], []
    for n, s, c in zip(sizes, sources, clusters):
        fits = [(left, b) for b, (left, ss, cc) in enumerate(bins) if left >= n and s not in ss and c not in cc and left > 0]
        if fits:
            left, b = min(fits)
        else:
            left, b = 100, len(bins)
            bins.append((100, set(), set()))
        bins[b] = (left - n, bins[b][1] | {s}, bins[b][2] | {c})
        want.append((b, 100 - left))
    assert packing.best_fit(sizes, sources, clusters, 100) == want


def test_main_text():
    page = """<html><head><title>T</title></head><body><nav>menu</nav><div class="ad">buy</div><article><header>h</header><h1>Head&amp;</h1>
    <p>One <b>two</b>th&nbsp;ree<br>four<p>five<script>var x="</p>"</script><aside>side</aside><div id="comments">c</div><form>f</form></article><footer>x</footer></body>"""
    assert pages.main_text(page) == "Head& One twoth ree four five"
    assert pages.main_text(None) == pages.main_text("") == "" and pages.main_text("plain < text") == "plain < text"


def test_style_tree_cuts_what_repeats(spark):
    rows = [(i, "http://h.example/x", f"<body><div class='zone'>same words each time</div><div class='body'>text {i} is its own</div></body>") for i in range(30)]
    rows += [(99, None, None), (98, "http://o.example/", "<body><div class='zone'>kept here</div></body>")]
    df = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, text string")
    out = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
    assert out == {i: f"text {i} is its own" for i in range(30)} | {99: "", 98: "kept here"}
    assert pages.extract(df.limit(0)).collect() == []


def test_quality(spark, docs, nothing):
    out = quality.cascade(docs, report=quality.BASE).collect()
    assert len(out) == docs.count() and all((r["rejected_by"] is None) == r["kept"] for r in out)
    assert quality.keep_good(docs).count() == sum(r["kept"] for r in out)
    assert quality.cascade(nothing).collect() == [] and quality.keep_good(nothing).collect() == []


@have_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_word_hashes_follow_words():
    from wardframe.llm.neardup import shingle_set
    from wardframe.llm.text import word_hashes, words_of

    texts = [None, "", " \t\n", "a", "A b  a B", "x" * 200 + " y " + "x" * 200, "é\x85a \x1cb é\x85a", "ab a b ba", "\x0ba\x0c", "Ä ä Z z"]
    for text in texts:
        words, got = words_of(text), word_hashes(text).tolist()
        assert len(got) == len(words)
        assert [[a == b for b in got] for a in got] == [[a == b for b in words] for a in words]
    assert word_hashes("A Ä", lower=True).tolist() == word_hashes("a Ä").tolist()
    assert len(shingle_set("one two three")) == 1 and len(shingle_set("a b c d e f " * 50)) == 6


def with_edits(words, n, seed):
    """The words with ``n`` of them replaced, far enough apart to cost five shingles each."""
    edited = list(words)
    for i in range(n):
        edited[12 * i + 6] = f"edit{seed}x{i}"
    return " ".join(edited)


def near_classes(texts, percent):
    """A label for each text, by all pairs of shingle sets; its own for an empty set."""
    sets = []
    for t in texts:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")]
        width = min(5, len(w))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if w else set())
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holding = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holding[x].add(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holding[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def test_pipeline_keeps_one_of_near_copies_at_80(spark):
    base = [words_from(50 + i, 400) for i in range(6)]
    texts = [t for i, b in enumerate(base) for t in (" ".join(b), with_edits(b, 8 + i, i), with_edits(b, 30, i))] + [None, "", "one two"]  # 0.73 to 0.82, and far
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    frames = [spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")]
    if os.path.isdir("/root/testdata/sf0.01"):
        frames.append(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for frame in frames:
        held = [(r["doc_id"], r["text"]) for r in frame.collect()]
        labels = near_classes([t for _, t in held], 80)
        best = {}
        for (doc, _), label in zip(held, labels, strict=True):
            best[label] = min(best.get(label, (True, 0)), (doc is None, doc or 0))
        want = sorted(Counter(doc if not none else None for none, doc in best.values()).items(), key=repr)
        got = corpus_pipeline.near_dedup(spark, frame, FOLDER).collect()
        assert sorted(Counter(r["doc_id"] for r in got).items(), key=repr) == want


def test_packing_keeps_near_copies_apart(spark):
    base = [words_from(70 + i, 100) for i in range(4)]
    texts = [t for i, b in enumerate(base) for t in (" ".join(b), with_edits(b, 1, i), with_edits(b, 2, i), " ".join(b) + " É", " ".join(b) + " é")]
    texts += ["ÉA " * 30, "éa " * 30, "x " * 9, None, ""]
    rows = [(i, t, f"source{i}") for i, t in enumerate(texts)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    labels = near_classes([t.lower() if t else t for t in texts], 80)
    assert labels[0] == labels[1] and labels[20] == labels[21] and len(set(labels)) == 8
    bins = defaultdict(list)
    for r in got:
        if r["bin"] is not None:
            bins[r["bin"]].append(labels[r["doc_id"]])
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    assert all(len(set(b)) == len(b) for b in bins.values()) and max(len(b) for b in bins.values()) > 1


def test_noise_names_are_whole_tokens():
    page = """<html class='header'><body class='no-sidebar header-fixed'><div class='content with-sidebar'><article class='social-post' id='promo'>
    <h1 class='post-header header'>Head</h1><p class='related-work'>kept</p><div class='ad'>a</div><div id='ad-12'>b</div><div class='x Sidebar'>c</div>
    <span class='share'>d</span><span class='share-price'>e</span></article></div></body></html>"""
    assert pages.main_text(page) == "Head kept e"
    assert pages.main_text("<body class='no-sidebar'><div class='content with-sidebar'>whole text</div></body>") == "whole text"
    assert pages.main_text("<body class='menu'><main role='banner'>whole text</main><div class='menu'>m</div></body>") == "whole text"


def test_style_tree_cuts_repeats_in_any_tag_and_share(spark):
    def own(i):
        return f"the text of page {i} is its own and is longer than any notice"

    rows = []
    for i in range(400):  # the advert is on 3 % of the pages, the notices are on all
        advert = "<div class='zone'>buy this</div>" if i < 12 else ""
        rows.append((i, f"<body><article><h1>Title {i}</h1><p>{own(i)}</p><p class='legal'>same words</p>{advert}<table><tr><td class='c'>cell</td></tr></table></article></body>"))
    copied = "<body><article><h2 class='t'>Copied</h2><p class='lead'>lead words</p><div class='story'>a copied article stays whole</div></article></body>"
    rows += [(1000 + i, copied) for i in range(30)]
    df = spark.createDataFrame([(i, "http://h.example/x", html) for i, html in rows], "page_id long, url string, html string").repartition(3)
    out = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
    assert out == {i: f"Title {i} {own(i)}" for i in range(400)} | {1000 + i: "Copied lead words a copied article stays whole" for i in range(30)}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_copies_without_their_original(spark, percent):
    """A group whose common text is absent: most pairs miss the threshold, and links are found beyond the pivots."""
    rng = np.random.default_rng(percent)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):
        words = list(base)
        # few edits at places that others share, so that shingles of an edit are not one document's own
        for at in rng.choice(range(0, 150, 10), int(rng.integers(2, 6)), replace=False):
            words[at] = f"e{rng.integers(2)}"
        rows.append((i, " ".join(words[:150 - int(rng.integers(0, 12))])))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    least = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = max(least[i], least[j]), min(least[i], least[j])
                least = [new if c == old else c for c in least]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    assert pulled(got.select("doc_id", "component_id")) == sorted(enumerate(least), key=repr)
    assert len(set(least)) > 1
