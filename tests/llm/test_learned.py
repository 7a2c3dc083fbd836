"""Toxicity, main texts of pages, benchmark items, and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhawk.llm import decontamination, html_text, toxicity
from tests.llm.frames import ODD_TEXTS, documents, no_documents, odd_documents, words
from tests.llm.test_near_duplicates import plain_groups
from tests.llm.test_repeats import plain


def toxic_rows(n=400, seed=3):
    """Labelled texts; half of the toxic ones use words of no lexicon, with endings."""
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        own, bad = words(40, 5000 + i).split(), i % 5 == 0
        if bad:
            own[draw.randrange(40)] = f"zork{draw.choice(['en', 'es', 'ua', 'yt'])}" if i % 2 else "idiot"
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxic_texts_are_told_from_others(spark):
    rows, labels = toxic_rows()
    labels_df = spark.createDataFrame([*labels, (0, None), (9999, 1), (None, 0), (0, 1), (3, 7)], "doc_id long, toxic int")
    got = toxicity.toxicity(documents(spark, [*rows, *ODD_TEXTS]), labels_df, F.col("doc_id") % 3 != 1)
    odd = {i for i, _ in ODD_TEXTS}
    held = [r for r in got.collect() if r["held_out"] and r["doc_id"] not in odd]
    truth = dict(labels)
    assert len(held) > 100 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert got.count() == len(rows) + len(ODD_TEXTS)
    assert all(0 <= r["score"] <= 1 for r in got.collect())


def test_toxicity_of_odd_rows_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    df = odd_documents(spark).unionByName(odd_documents(spark).limit(1).withColumn("text", F.lit("you pathetic stupid scum")))
    got = toxicity.toxicity(df, none, F.lit(True)).collect()
    assert len(got) == len(ODD_TEXTS) + 1
    assert max(got, key=lambda r: r["score"])["doc_id"] == 1
    kept = toxicity.without_toxic(odd_documents(spark), none)
    assert kept.columns == odd_documents(spark).columns and kept.count() == len(ODD_TEXTS)
    assert toxicity.toxicity(no_documents(spark), none, F.lit(True)).count() == 0


def test_the_label_model_finds_accuracies_and_copies():
    """Two voters that always agree count about as one; a random voter counts for nothing."""
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.2
    votes = np.zeros((20_000, len(toxicity.VOTERS)), int)
    votes[:, 0] = np.where(y, rng.random(20_000) < 0.8, rng.random(20_000) < 0.02)
    votes[:, 1] = votes[:, 0]
    votes[:, 2] = np.where(y, rng.random(20_000) < 0.6, rng.random(20_000) < 0.01)
    votes[:, 3] = rng.random(20_000) < 0.3
    votes[:, 4] = np.where(y, rng.random(20_000) < 0.5, rng.random(20_000) < 0.05)
    votes[:, 5] = np.where(y, rng.random(20_000) < 0.7, rng.random(20_000) < 0.1)
    masks = (votes << np.arange(votes.shape[1])).sum(axis=1)
    patterns, counts = np.unique(masks, return_counts=True)
    gold = masks[:2000], y[:2000].astype(int)
    model = toxicity.fit_label_model(patterns, counts, gold, 0.2)
    assert model.prior == pytest.approx(0.2, abs=0.03)
    one = np.zeros((4, votes.shape[1]), int)
    one[1, :2], one[2, 2], one[3, 3] = 1, 1, 1
    odds = model.log_odds(one)
    assert odds[1] - odds[0] == pytest.approx(np.log(0.8 / 0.02) - np.log(0.2 / 0.98), abs=1)
    assert odds[2] - odds[0] == pytest.approx(np.log(0.6 / 0.01) - np.log(0.4 / 0.99), abs=1)
    assert abs(odds[3] - odds[0]) < 0.3


def test_beginnings_that_come_again_tell_where_single_ones_do_not(spark):
    draw, rows, labels = random.Random(5), [], []
    for i in range(300):
        own, bad = words(40, 9000 + i).split(), i % 5 == 0
        # Every third clean text has one such word as well.
        for k in range(3 if bad else int(i % 3 == 0)):
            own[draw.randrange(0, 13) + 13 * k] = f"grumpf{'abcdefgh'[draw.randrange(8)] * draw.randrange(1, 9)}"
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    docs, labels_df = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    stems = toxicity.mined_stems(docs.join(labels_df, "doc_id"), "text", "toxic")
    assert any(x.startswith(f"{toxicity.AGAIN}grum") for x in stems) and not any(x.startswith("grum") and len(x) <= 6 for x in stems)
    got = toxicity.toxicity(docs, labels_df, F.col("doc_id") % 3 != 1).where("held_out").collect()
    truth = dict(labels)
    assert len(got) == 100 and all(r["predicted"] == truth[r["doc_id"]] for r in got)
    assert toxicity.Votes(stems).of("grumpfa x grumpfb")[0] and not toxicity.Votes(stems).of("grumpfa x")[0]


def test_posteriors_follow_labels_and_votes():
    odds = np.array([-30.0, 30.0, -30.0, 30.0])
    got = toxicity.posterior(odds, np.array([3.5, -3.5, 0, 0]))
    assert got[0] > 0.8 and got[1] < 0.2 and got[2] < 1e-6 and got[3] > 1 - 1e-6


def test_most_labelled_rows_of_every_class_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 3 != 1).where("held_out").join(labels, "doc_id")
    found, wrong, toxic = got.agg(F.sum(F.col("predicted") * F.col("toxic")), F.sum(F.col("predicted") * (1 - F.col("toxic"))), F.sum("toxic")).first()
    assert found >= 0.83 * toxic and wrong <= 0.03 * found


PAGE = """<html><head><title>T</title><script>x = "<p>no</p>"</script></head><body><header><div class="logo">Site</div></header>
<nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies to make things better for you.</div>
<main><article><h1>Head</h1><p>One  two\nthree &amp; four &lt;five&gt; six seven.</p><!-- <p>no</p> --><p>Short.<p>Next <b>bold</b> one.
<div class="related"><a href=x>See also this</a></div><p>More text of the article itself goes on and on here.</p></article></main>
<aside class="sidebar"><p>Buy our things now, they are nice.</p></aside><section id="comments"><h3>Comments</h3>
<div class="comment"><p>I liked this article very much indeed, thanks a lot for it.</p></div></section>
<form><label>Name</label><input></form><footer>&copy; 2020</footer></body></html>"""


def test_blocks_of_a_page():
    blocks = html_text.blocks_of("a<p>b<br>c &amp d<div class='x y-z'>e<i>f</i></div><style>p{}</style>g<td title='1>2'>h</td><!-- i -->j<p q")
    assert [b.text for b in blocks] == ["a", "b c & d", "ef", "g", "h", "j"]
    assert blocks[2].path == ("p", "div", ".x", ".y", ".z")
    assert html_text.blocks_of("") == [] and html_text.blocks_of("<p><a" + " x" * 100_000) == []


def test_main_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    odd = [(-1, "u", PAGE), (-2, None, None), (-3, "u", ""), (None, "u", "<nav>x</nav>"), (-1, "u", PAGE)]
    pages = table.unionByName(spark.createDataFrame(odd, table.schema)).withColumn("text", F.lit(1))
    rows = html_text.page_texts(pages).collect()
    assert len(rows) == pages.count()
    by = {r["page_id"]: r for r in rows}
    want = "Head\n\nOne two three & four <five> six seven.\n\nShort.\n\nNext bold one.\n\nMore text of the article itself goes on and on here."
    assert by[-1]["text"] == want and by[-1]["n_chars"] == len(want)
    assert by[-2]["text"] == by[-3]["text"] == by[None]["text"] == ""
    for r in table.collect():
        inside = [b.text for b in html_text.blocks_of(r["html"]) if "article" in b.path]
        assert by[r["page_id"]]["text"] == "\n\n".join(inside)
    assert html_text.page_texts(pages.limit(0)).count() == 0


ARTICLE = "<h1>Rivers and mills</h1><p>The first mill of the valley was built in the spring, long before the road.</p><p>It ground the corn of nine villages, and later sawed timber for the ships.</p>"
ARTICLE_TEXT = "Rivers and mills\n\nThe first mill of the valley was built in the spring, long before the road.\n\nIt ground the corn of nine villages, and later sawed timber for the ships."
MENU = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
FOOT = "<footer><p>&copy; 2020</p></footer>"


def test_open_elements_and_names_of_the_whole_page_lose_no_article(spark):
    pages = [
        f"<body>{MENU}<button>Menu<article>{ARTICLE}</article>{FOOT}</body>",
        f"<body>{MENU}<svg><path d=x><article>{ARTICLE}</article>{FOOT}</body>",
        f"<head><title>Mills</head><body>{MENU}<article>{ARTICLE}</article>{FOOT}</body>",
        f"<body>{MENU}<div><button>Menu</div><main><div>{ARTICLE}</div></main><button>Up</button>{FOOT}</body>",
        f"<body class='has-sidebar no-comments'>{MENU}<div>{ARTICLE}</div>{FOOT}</body>",
        f"<body><form id='aspnetForm' action=x>{MENU}<article>{ARTICLE}</article>{FOOT}</form></body>",
        f"<body>{MENU}<article>{ARTICLE.replace('<h1>', '<header><h1>').replace('</h1>', '</h1></header>')}</article>{FOOT}</body>",
        f"<body>{MENU}<article>{ARTICLE.replace('nine', '<math><mi>nine</mi><annotation>9</annotation></math>')}</article>{FOOT}</body>",
        f"<body><template><article><p>Not this one.</p></article></template>{MENU}<article>{ARTICLE}</article>{FOOT}",
    ]
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    table = given.unionByName(spark.createDataFrame([(-1 - i, "u", x) for i, x in enumerate(pages)], given.schema))
    got = {r["page_id"]: r["text"] for r in html_text.page_texts(table).where("page_id < 0").collect()}
    assert {i: t for i, t in got.items() if t != ARTICLE_TEXT} == {} and len(got) == len(pages)


def test_hidden_elements_end():
    def texts(page):
        return [b.text for b in html_text.blocks_of(page)]

    assert texts("<p>a <button>b</p><p>c</p>") == ["a", "c"]
    assert texts("<p>a <button><div>b</div></button> c</p>") == ["a c"]
    assert texts("<select><option>a<option>b</select><p>c") == ["c"]
    assert texts("<noscript><p>a</p></noscript><p>b</p><script>c</scrip><p>d") == ["b"]
    assert texts("<div><noscript><p>a</p></div><p>b</p>") == ["a", "b"]
    assert texts("<svg><title>a</title><text>b</text></svg>c<textarea>d") == ["c"]
    assert texts("<svg><!-- </svg> --><style>x</style></svg>a<title>b <p>c</title>d<svg/>e") == ["ade"]
    assert texts("<div>" + "<button>a<div><svg>b" * 20_000)[:2] == []
    assert len(texts("<noscript><div>x" * 20_000)) > 0


def test_gradients_are_those_of_small_steps():
    rng = np.random.default_rng(1)
    model = html_text.Labeller.fresh(2)
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, into = rng.normal(size=(2, 4, html_text.INPUT)) * 0.3, rng.normal(size=(2, 4, html_text.HIDDEN))
    _, kept = html_text._run(w, "f", x)
    grads = html_text._back(w, "f", x, kept, into)
    for name in ("fx", "fh", "fb"):
        at = tuple(rng.integers(0, n) for n in w[name].shape)
        values = []
        for step in (1e-3, -1e-3):
            moved = w | {name: w[name].copy()}
            moved[name][at] += step
            values.append((html_text._run(moved, "f", x)[0].astype(np.float64) * into).sum())
        assert grads[name][at] == pytest.approx((values[0] - values[1]) / 2e-3, abs=2e-3)


def plain_alignment(a, b):
    best, rows = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if x == y else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


def test_alignment_is_that_of_the_plain_recurrence():
    draw = random.Random(3)
    for _ in range(300):
        a = [draw.randrange(5) for _ in range(draw.randrange(1, 15))]
        b = [draw.randrange(5) for _ in range(draw.randrange(1, 25))]
        score, low, high = decontamination.align(a, b)
        assert score == plain_alignment(a, b) and (score == 0 or plain_alignment(a, b[low:high]) == score)


def test_copies_and_edited_copies_of_items_are_found(spark):
    items = [(i, words(40, 700 + i)) for i in range(8)] + [(20, "two words"), (21, None), (22, "..."), (20, "two words")]
    edited = words(40, 703).split()
    edited[7], edited[20:22] = "other", ["and", "more", "besides"]
    rows = [
        (1, f"{words(50, 1)} {items[0][1].upper()}, {words(50, 2)}"), (2, f"{words(50, 3)} {' '.join(edited)}"),
        (3, words(300, 4)), (4, f"{words(20, 5)} {' '.join(items[5][1].split()[:12])} {words(20, 6)}"), (5, "Two words!"), (1, items[1][1]),
        *((100 + i, f"{words(10, 50 + i)} {items[7][1]} {words(10, 90 + i)}") for i in range(120)), *ODD_TEXTS,
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, rows)
    got = decontamination.benchmark_matches(df, benchmark).collect()
    found = sorted((r["doc_id"], r["item_id"]) for r in got)
    assert found == sorted([(1, 0), (1, 1), (2, 3), (5, 20), (5, 20), *((100 + i, 7) for i in range(120))])
    exact = {(r["doc_id"], r["item_id"]): (r["score"], r["first_word"], r["end_word"]) for r in got}
    assert exact[(1, 0)] == (1.0, 50, 90) and 0.7 < exact[(2, 3)][0] < 1
    kept = decontamination.without_benchmark(odd_documents(spark).unionByName(odd_documents(spark).limit(1).withColumn("text", F.lit(items[2][1]))), benchmark)
    assert kept.count() == len(ODD_TEXTS) and kept.columns == odd_documents(spark).columns
    assert decontamination.benchmark_matches(df, benchmark.limit(0)).count() == 0
    assert decontamination.benchmark_matches(df.limit(0), benchmark).count() == 0


def with_edits(text, places):
    return " ".join(f"edit{i}" if i in places else w for i, w in enumerate(text.split()))


def test_copies_that_lost_half_of_their_five_word_sequences_are_found(spark):
    items = [(0, words(40, 720)), (1, words(20, 721)), (2, words(40, 722))]
    rows = [
        (1, f"{words(50, 1)} {with_edits(items[0][1], {7, 15, 23, 31})} {words(50, 2)}"),
        (2, f"{words(50, 3)} {with_edits(items[1][1], {6, 13})} {words(50, 4)}"),
        (3, f"{words(50, 5)} {items[2][1]}"), (4, f"{with_edits(items[2][1], {7, 15, 23, 31})} {words(50, 6)}"), (5, words(200, 7)),
    ]
    benchmark, df = spark.createDataFrame(items, "item_id long, text string"), documents(spark, rows)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.benchmark_matches(df, benchmark).collect()}
    assert got == {(1, 0): 0.85, (2, 1): 0.85, (3, 2): 1.0, (4, 2): 0.85}
    assert [r["doc_id"] for r in decontamination.without_benchmark(df, benchmark).collect()] == [5]


def edited(own, draw, kind):
    """Words with every fifth or third one replaced, one put in after each, or some edits of any kind."""
    if kind < 2:
        return [f"e{draw.randrange(10**9)}" if i % (5, 3)[kind] == 2 else w for i, w in enumerate(own)]
    if kind == 2:
        return [x for w in own for x in (w, f"e{draw.randrange(10**9)}")]
    return [x for w in own for x in ([], [w, f"e{draw.randrange(10**9)}"], [f"e{draw.randrange(10**9)}"], *[[w]] * 7)[draw.randrange(10)]]


def test_all_pairs_that_align_well_are_found(spark):
    draw = random.Random(11)
    items = [(i, words(draw.randrange(5, 41), 800 + i, 60 if i % 3 else 4000)) for i in range(24)] + [(24, words(20, 850))]
    rows = []
    for i, (_, text) in enumerate(items):
        for kind in range(4):
            around = words(30, 900 + i).split() if i % 3 else words(30, 900 + i, 60).split()
            rows.append((10 * i + kind, " ".join([*around[:15], *edited(text.split(), draw, kind), *around[15:]])))
    spread = items[24][1].split()
    rows += [(1000, " ".join(f"e{i}" if i % 5 == 2 else w for i, w in enumerate(spread))), (1001, " ".join(f"e{i}" if i % 3 == 2 else w for i, w in enumerate(spread)))]
    want = {}
    for d, text in rows:
        for i, item in items:
            score = plain_alignment(item.split(), text.split()) / (2 * len(item.split()))
            if score >= decontamination.LEAST_SCORE:
                want[(d, i)] = score
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.benchmark_matches(documents(spark, rows), benchmark).collect()}
    assert want[(1000, 24)] == 0.7 and want[(1001, 24)] == 0.55 and len(want) > 90
    assert got == want
    kept = decontamination.without_benchmark(documents(spark, rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_the_pipeline_stage_by_stage(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = {r[0] for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns and kept[name] <= {r[0] for r in before.select("doc_id").collect()}
        old = sorted((r["doc_id"], r["text"]) for r in before.collect())
        if name == "near duplicates":
            assert kept[name] == set(plain_groups(old).values())
        if name == "repeated passages":
            gone = {i for (i, _), (n, cut, _) in zip(old, plain(old), strict=True) if n and n == cut}
            assert kept[name] == {i for i, _ in old} - gone
            assert {r["doc_id"]: len(r["text"].split()) for r in docs.collect()} == {
                i: n - cut for (i, _), (n, cut, _) in zip(old, plain(old), strict=True) if i not in gone
            }
    assert kept["packing"] == kept["benchmark decontamination"]
    assert {r[0] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()} == kept["packing"]
