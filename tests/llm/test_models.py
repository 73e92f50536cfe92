"""Scores, quality rules, packing, chats, leaks and main texts against small direct computations."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import chat, decontaminate, main_text, maxent, packing, quality


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_base_scores_and_held_out_gain(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = df.select("doc_id", "text").collect()
    counts = Counter(t for i, x in docs if zlib.crc32(str(i).encode()) % 10 for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    for frequent in (maxent.FREQUENT, 50):
        got = {r["doc_id"]: r for r in maxent.score_texts(df, frequent=frequent).collect()}
        for i, text in docs:
            found = tokens(text)
            base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in found)
            r = got[i]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (zlib.crc32(str(i).encode()) % 10 == 0, len(found), sum(t in counts for t in found), n)
            assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_softmax_is_a_distribution():
    model = maxent.Model([3, 1, 2], np.zeros(maxent.CLASSES))
    rng = np.random.default_rng(0)
    model.weights += rng.normal(size=model.weights.shape).astype(np.float32)
    rows = rng.integers(0, 1 << maxent.FEATURE_BITS, (maxent.FEATURES, 50)).astype(np.int32)
    chances = lambda c: maxent.log_chances(model, rows, np.full(50, c))
    assert np.allclose(sum(np.exp(chances(c)) for c in range(maxent.CLASSES)), 1, atol=1e-4)
    before = chances(5).sum()
    for _ in range(20):
        maxent.step(model, rows, np.full(50, 5))
    assert chances(5).sum() > before


def test_gradients_are_summed_by_row():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(300, 7)).astype(np.float32)
    sizes = np.array([90, 17, 16, 15, 2, 1, 1])  # more rows than are added at once, as many, and fewer
    order = rng.integers(0, 300, sizes.sum())
    first = np.cumsum(sizes) - sizes
    got = maxent.group_sums(values, order, first, sizes)
    assert np.allclose(got, [values[order[a:a + n]].astype(np.float64).sum(axis=0) for a, n in zip(first, sizes)], atol=1e-4)


def test_large_logits_stay_a_distribution():
    model = maxent.Model([1], np.zeros(maxent.CLASSES))
    model.weights[:, 3], model.weights[:, 4] = 200, -200
    rows = np.zeros((maxent.FEATURES, 2), np.int32)
    assert np.allclose(maxent.log_chances(model, rows, np.array([3, 4])), [0, -1200])


def repeats(words):
    runs = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    found = Counter(runs)
    return len({k + j for k, r in enumerate(runs) if found[r] > 1 for j in range(5)})


def test_quality_counts(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    for i, text in df.select("doc_id", "text").collect():
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        n = len(words)
        want = (n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats(words))
        r = got[i]
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r["base_failed"] == (n < 10 or 100 * want[4] > 20 * n)
        assert not (r["base_failed"] and r["kept"])


def test_clean_documents_stay_and_outliers_go(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    good = quality.quality_rules(df).where("NOT base_failed").join(df.select("doc_id", "quality"), "doc_id")
    kept = {r["quality"]: r["kept"] for r in good.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] >= 0.98 and kept[0] < 0.5


def test_estimates_withstand_outliers(spark):
    rng = np.random.default_rng(1)
    p = len(quality.FEATURES)
    scales = np.array(list(quality.FEATURES.values()))
    good = rng.normal(size=(700, p)) * 3 * scales
    bad = rng.normal(size=(200, p)) * 0.1 * scales + 60 * scales
    values = np.concatenate([good, bad])
    df = spark.createDataFrame([("a", None, *map(float, v)) for v in values], ["group_0", "group_1", *quality.FEATURES] and
                               "group_0 string, group_1 string, " + ", ".join(f"{c} double" for c in quality.FEATURES))
    (row,) = quality.robust_estimates(df, ["group_0", "group_1"]).collect()
    assert np.all(np.abs(np.array(row["centre"]) / scales) < 1)
    inverse = np.zeros((p, p))
    inverse[np.tril_indices(p)] = row["shape"]
    distance = ((values - row["centre"]) @ inverse.T) ** 2
    limit = quality.chi2_quantile(p, 1 - quality.TAIL)
    assert (distance[:700].sum(1) <= limit).all() and (distance[700:].sum(1) > limit).all()


def test_chi_squared():
    assert quality.chi2_share(2, 2 * math.log(20)) == pytest.approx(0.95)
    assert quality.chi2_quantile(1, 0.95) == pytest.approx(3.841459, rel=1e-6)


def unpacked(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["size"]))
    for placed in bins.values():
        end = 0
        for offset, size in sorted(placed):
            assert offset == end
            end += size
        assert end <= capacity
    return bins


@pytest.mark.parametrize("sizes", [
    [1] * 500, [64] * 40, [33] * 64 + [31] * 64, [64, 1, 63, 2, 62, 3], [], [40] * 30 + [24] * 30, list(range(1, 65)) * 4,
])
def test_packing_is_gapless_and_tight(spark, sizes):
    pieces = spark.createDataFrame(list(enumerate(sizes)), "id long, size long")
    rows = packing.best_fit(pieces, 64).join(pieces, "id").collect()
    assert sorted(r["id"] for r in rows) == list(range(len(sizes)))
    bins = unpacked(rows, 64)
    assert len(bins) <= -(-sum(sizes) // 64) * 1.1 + 1


@pytest.mark.parametrize("sizes, want", [
    ([1] * 10_000, 3), ([2100] * 1000 + [20] * 99_000, 1000), ([3000] * 1000 + [40] * 27_000, 1000), ([3000] * 10 + [500] * 4 + [40] * 200 + [1] * 3000, 11),
])
def test_packing_fills_open_gaps_before_it_opens(spark, sizes, want):
    pieces = spark.createDataFrame([(k, s) for k, s in enumerate(sizes)], "id long, size long")
    rows = packing.best_fit(pieces.repartition(7)).join(pieces, "id").collect()
    assert len({r["id"] for r in rows}) == len(rows) == len(sizes)
    assert len(unpacked(rows, 4096)) == want


def test_packing_leaves_what_best_fit_leaves():
    rng = random.Random(8)
    for capacity in (1, 7, 64, 300):
        sizes = sorted((rng.choice([rng.randint(1, capacity), 1, capacity // 3 + 1, capacity // 9 + 1]) for _ in range(900)), reverse=True)
        gaps = []
        for size in sizes:
            gap = min((g for g in gaps if g >= size), default=capacity)
            if gap in gaps:
                gaps.remove(gap)
            gaps.append(gap - size)
        counts, left = Counter(sizes), {}
        rows = packing.plan(counts, capacity).tolist()
        for k, (size, first, sequence, each, offset) in enumerate(rows):
            until = rows[k + 1][1] if k + 1 < len(rows) and rows[k + 1][0] == size else counts[size]
            for number in range(until - first):
                spot = sequence + number // each
                left[spot] = left.get(spot, capacity) - size
        assert sorted(left.values()) == sorted(gaps)


def test_sweep_takes_the_smallest_gap(spark):
    items = spark.createDataFrame([(1, 50), (2, 30), (3, 30), (4, 10), (5, 70)], "id long, size long")
    gaps = spark.createDataFrame([(11, 60), (12, 30), (13, 12), (14, 11), (15, 5)], "id long, size long")
    found = {r["id"]: r["other"] for r in packing.sweep(items, gaps).where("kind = 1").collect()}
    assert found == {1: 11, 2: 12, 3: None, 4: 14, 5: None} or found == {1: 11, 2: None, 3: 12, 4: 14, 5: None}


def test_pieces_hold_the_tokenizers_ids(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    more = [(10_001, "It's a test, isn't it?... Yes.,\x1c İ ſ K ́a <|endoftext|> B<|ENDOFTEXT|>"), (10_002, None), (10_003, "a.b,c. 3.5, (x). 'tis ''s."), (10_004, "word, " * 6000)]
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = packing.pack_documents(df).withColumnRenamed("length", "size").collect()
    bins = unpacked(rows, 4096)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in df.collect():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want = [(n, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for n, k in enumerate(range(0, len(ids), 4096))]
        assert sorted((r["piece"], r["start"], r["size"], r["ids_crc32"]) for r in pieces[i]) == want, i
    assert len(bins) <= 1.05 * sum(r["size"] for r in rows) / 4096 + 2


def cheapest(given):
    """Least cost over all labellings, by trying every one."""
    best = chat.NEVER
    for states in itertools.product(range(1, 4), repeat=len(given)):
        cost = sum(chat.LINK[a][b] + chat.relabel_cost(g, b) for a, b, g in zip((0, *states), states, given))
        best = min(best, cost + chat.END[states[-1]])
    return best


def test_repairs_are_cheapest_whatever_the_fragments(spark):
    rng = random.Random(4)
    names = [None, "system", "user", "assistant"]
    chats = {c: [rng.randrange(4) for _ in range(rng.randrange(1, 7))] for c in range(60)}
    rows = [(c, t, names[g], f"{c}-{t}") for c, given in chats.items() for t, g in enumerate(given)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for parts in ("1", "7", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = chat.repair_chats(df).orderBy("conv_id", "out_turn", "place").collect()
        seen.append([(r["conv_id"], r["out_turn"], r["role"], r["text"], r["action"], r["rendered"]) for r in found])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
    for c, given in chats.items():
        mine = [r for r in seen[0] if r[0] == c]
        states = [names.index(r[2]) for r in mine if r[4] != "insert"]
        cost = sum(chat.LINK[a][b] + chat.relabel_cost(g, b) for a, b, g in zip((0, *states), states, given)) + chat.END[states[-1]]
        assert cost == cheapest(given)
        turns = [role for _, role in sorted({(r[1], r[2]) for r in mine})]
        assert [r[1] for r in mine] == sorted(r[1] for r in mine) and len({r[1] for r in mine}) == mine[-1][1] + 1
        legal = turns[1:] if turns[0] == "system" else turns
        assert legal and all(role == ("user", "assistant")[k % 2] for k, role in enumerate(legal))
        text = "".join(r[5] for r in mine)
        assert text.count(chat.OPEN) == text.count("<|im_end|>\n") == len(turns)


def test_leaks_against_common_windows(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    strip = lambda w: w.lower().strip("\"'`.,;:!?()[]{}<>|*#$%&=~^+-/\\_")
    runs = lambda t: {tuple(w[k:k + 5]) for w in [[x for x in map(strip, t.split()) if x]] for k in range(max(1, len(w) - 4))}
    wanted = {(i, j) for i, t in docs.select("doc_id", "text").collect() for j, u in items.select("item_id", "text").collect() if len(runs(t) & runs(u)) >= 0.6 * len(runs(u))}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    assert wanted and got == wanted


def test_other_parameters_are_caught(spark):
    item = "If Alice buys 12 apples at 3 dollars each and then sells half of them to Bob for twice the price how much money does Alice have"
    docs = [
        (1, item), (2, "Well. " + item.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "40").replace("dollars", "euros")),
        (3, item.upper()), (4, "If it rains we stay at home and then sells half of nothing to anyone for twice the price of tea"), (5, item.replace(" ", " | ")),
    ]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    got = {r["doc_id"]: r["n_reparameterised"] for r in found.collect()}
    assert got.keys() == {1, 2, 3, 5} and got[2] > 0 and got[1] == 0


def test_whole_items_are_leaks_whatever_stands_before_them(spark):
    item = "If Alice buys 12 apples at 3 dollars each and sells 5 of them to Bob for 7 dollars how much money does Alice have"
    second = item.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "40").replace(" 3 ", " 9 ").replace(" 5 ", " 8 ").replace(" 7 ", " 6 ")
    third = item.replace("Alice", "Erin").replace("Bob", "Frank").replace("12", "50").replace(" 3 ", " 2 ").replace(" 5 ", " 4 ").replace(" 7 ", " 11 ")
    docs = [(1, f"{item}? {second}?"), (2, f"{second}? {item}?"), (3, f"{third}? {second}? {item}?"), (4, third)]
    items = spark.createDataFrame([(7, item), (8, second)], "item_id long, text string")
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    got = {(r["doc_id"], r["item_id"]): r["n_reparameterised"] for r in found}
    assert got.keys() == {(i, j) for i in (1, 2, 3, 4) for j in (7, 8)}
    assert all(n == 0 for (i, _), n in got.items() if i < 4) and got[4, 7] > 0


@pytest.mark.parametrize("item, other", [
    ("Tom has 4 red pens. Ann has 6 blue pens. Tom gives 2 pens to Ann. How many pens does Ann have now?",
     "Kim has 7 red pens. Joe has 9 blue pens. Kim gives 3 pens to Joe. How many pens does Joe have now?"),
    ("Tom runs 3 miles in 2 hours. Ann runs 5 miles in 4 hours. Who is faster?", "Kim runs 6 miles in 7 hours. Joe runs 8 miles in 9 hours. Who is faster?"),
])
def test_names_that_begin_sentences_are_parameters(spark, item, other):
    no = "Tom walks home. Ann has a dog. How many people live in town now? Who is there for 2 hours?"
    docs = spark.createDataFrame([(1, other), (2, f"So it is.\n{other} Yes."), (3, no), (4, item)], "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    got = {r["doc_id"]: r["n_reparameterised"] for r in found}
    assert got.keys() == {1, 2, 4} and got[1] > 0 and got[2] > 0 and got[4] == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="top"><a href="/">Home, sweet</a></header>
<nav><ul><li><a href="/a">A, b and a longer menu entry with commas, more, and more</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, of course, and ask you to agree to all of them.</p></div>
<div id="page"><div class="story"><h1>Head &amp; line</h1><p>First para, with a <a href="x">link</a> and <b>bold</b>&nbsp;text,
over two lines.<p>Second one, unclosed, long enough to count as a paragraph.<script>var x = "</p>";</script><ul><li>item one<li>item two</ul>tail text</div>
<div class="sidebar"><p>Some text, at the side, which is also long enough, and has commas, many.</p></div></div>
<form><p>Sign up, now, for a very long letter every week, please.</p></form><div class="comments"><p>Reader: I liked it, a lot, and want to say more about it, here.</p></div><footer>&copy; me, 2020</footer></body></html>"""


def test_main_text():
    assert main_text.main_text(PAGE).split("\n") == [
        "Head & line", "First para, with a link and bold text, over two lines.", "Second one, unclosed, long enough to count as a paragraph.", "item one", "item two", "tail text"]
    assert main_text.main_text("<p>a<!-- <p>b --><p>c <script>d") == "a\nc"
    assert main_text.main_text("no markup &lt;b&gt; at all") == "no markup <b> at all"
    assert main_text.main_text('<div hidden>x</div><p title="a>b">shown</p>') == "shown"
    assert main_text.main_text("<div>" * 20_000 + "deep") == "deep"


@pytest.mark.parametrize("name", [
    "container has-sidebar", "post no-comments", "layout-with-menu", "main-content social-post", "entry share-enabled", "rail-history", "col-md-8 content", "wrapper"])
def test_wrappers_keep_their_article(name):
    said = [f"Paragraph {k} of the story, which goes on, with commas, for a good while." for k in range(5)]
    inner = "".join(f"<p>{x}</p>" for x in said)
    aside = '<div class="related-posts"><p>Another story, which you may like, too, if you liked this.</p></div><div class="comments"><p>Reader: I liked it, a lot, yes.</p></div>'
    for page in (f'<div class="{name}">{inner}</div>', f'<body><div class="{name}">{inner}{aside}</div></body>', f'<div class="{name}"><h1>T</h1>{inner}</div><div class="sidebar"><p>At the side, text, and more text, and links.</p></div>'):
        assert [x for x in main_text.main_text(page).split("\n") if x != "T"] == said, page


def paragraph_points(page):
    """Points of each element of a small page without ``article``, straight from the rule: by parsing with ids."""
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.stack, self.text, self.linked, self.parent, self.in_link = ["root"], Counter(), Counter(), {"root": None}, 0

        def handle_starttag(self, tag, attrs):
            name = dict(attrs).get("id", f"{tag}{len(self.parent)}")
            self.parent[name] = self.stack[-1]
            self.stack.append(name)
            self.in_link += tag == "a"

        def handle_endtag(self, tag):
            self.stack.pop()
            self.in_link -= tag == "a"

        def handle_data(self, data):
            for name in self.stack:
                self.text[name] += len(data)
                self.linked[name] += len(data) if self.in_link else 0
                self.commas = getattr(self, "commas", Counter())
                self.commas[name] += data.count(",")

    tree = Tree()
    tree.feed(page)
    points = Counter()
    for name in tree.parent:
        if name[0] == "p" and tree.text[name] >= 25:
            given, up = 1 + tree.commas[name] + min(tree.text[name] / 100, 3), tree.parent[name]
            for divisor in (1, 2, 6, 9):
                if up is None:
                    break
                points[up] += given / divisor
                up = tree.parent[up]
    return {name: points[name] * (1 - tree.linked[name] / tree.text[name]) for name in points}


def test_best_container_by_the_rule():
    """Pages of unnamed boxes: the text comes from the box with the most points, found by a plain reading of the rule."""
    rng = random.Random(3)
    for _ in range(60):
        boxes = []
        for k in range(rng.randrange(2, 5)):
            words = lambda n: " ".join(rng.choice(["word", "and,", "so", "it,", "goes"]) for _ in range(n))
            inner = "".join(f'<p id="p{k}_{j}">{"<a>" if (link := rng.random() < 0.3) else ""}{words(rng.randrange(8, 40))}{"</a>" if link else ""}</p>' for j in range(rng.randrange(1, 6)))
            boxes.append(f'<div id="d{k}">{inner}</div>')
        points = paragraph_points("".join(boxes))
        best = max(points, key=lambda name: (points[name], name == "root", -int(name[1:] or 0) if name != "root" else 0))
        wanted = boxes if best == "root" else [boxes[int(best[1:])]]
        import re
        lines = [re.sub("<[^>]*>", "", p) for box in wanted for p in re.findall(r"<p[^>]*>(.*?)</p>", box)]
        got = main_text.main_text("".join(boxes)).split("\n")
        assert all(line in got for line in lines), (points, boxes)


@pytest.mark.parametrize("page", [
    "<a " * 330_000, "<b>" * 100_000 + "<li>" * 100_000, "<ul>" * 100_000 + "<li>" * 100_000, "<b>" * 100_000 + "</i>" * 100_000, '<a x=">" ' * 110_000, "<a '\">" * 140_000,
    "<td>" * 200_000, "<p><div>" * 120_000, "<" * 1_000_000, "<!-- " * 200_000, "<textarea>" * 100_000, "<div class='sidebar'>" * 50_000,
])
def test_long_broken_pages_take_time_by_their_length(page):
    import time

    start = time.process_time()
    main_text.main_text(page)
    assert time.process_time() - start < 12


def test_main_text_of_given_pages(spark, sf_dir):
    import html
    import re

    rows = {r["page_id"]: r["text"] for r in main_text.extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    for page_id, source in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect():
        article = re.search(r"<article>(.*)</article>", source, re.S)[1]
        blocks = re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", article))
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks.split("\0")]
        assert rows[page_id] == "\n".join(b for b in want if b)


def test_windows_of_many_texts_are_those_of_each():
    """Texts read together give the forms, places and fillings of texts read alone."""
    rng = random.Random(6)
    words = ["Tom", "Ann", "has", "4", "red", "pens.", "runs", "3", "miles", "in", "(two)", "hours?", "--", "Is", "it", "Kim", "5km", "...", "so,", "Éva"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(14))).encode() for _ in range(400)]
    table = decontaminate.word_table()
    for share in (1, 3):
        passes = lambda h, share=share: h % np.uint64(share) == 0
        want = []
        for i, text in enumerate(texts):
            plain, _, forms = decontaminate.window_forms(table, text)
            seen, before = {}, set()
            for found, slot in forms:
                for at in np.flatnonzero(passes(found)).tolist():
                    seen.setdefault((int(found[at].astype(np.int64)), at), slot)
            for (value, at), slot in seen.items():
                want.append((i, value, at, value not in before, plain[at:at + 5][slot[at:at + 5]].view(np.int64).tolist()))
                before.add(value)
        assert sorted(decontaminate._hits(table, texts, passes)) == sorted(want)


def test_an_empty_benchmark_leaks_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs, none).collect() == []
    assert decontaminate.without_leaks(docs, none).count() == 2
