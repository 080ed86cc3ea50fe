"""Decontamination, packing, HTML extraction and the pipeline."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kithwork.llm import decontamination, html_extraction, minhash_dedup, packing, quality
from tables_for_tests import LABELS, awkward, documents, words
from test_dedup import brute_minhash, brute_repeats

ITEMS = "item_id long, text string, doc_id string, coverage string"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_tiles(pattern, text, least):
    """Greedy string tiling by definition: the longest unmarked match first."""
    free_p, free_t, covered = [True] * len(pattern), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(pattern)):
            for t in range(len(text)):
                n = 0
                while p + n < len(pattern) and t + n < len(text) and free_p[p + n] and free_t[t + n] and pattern[p + n] == text[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return covered
        free_p[p : p + n], free_t[t : t + n] = [False] * n, [False] * n
        covered += n


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEMS)


def test_contaminations_equal_brute_force(spark):
    r = random.Random(6)
    items = [(i, " ".join(words(i, r.randrange(6, 30), 40))) for i in range(12)] + [(50, "w1 w2 w3"), (51, None), (52, "..."), (None, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for d in range(60):
        own = words(1000 + d, 40, 40)
        if d % 3 == 0:
            piece = tokens(items[r.randrange(12)][1])
            cut = r.randrange(len(piece))
            own[10:10] = piece[cut:] + (["gap"] if d % 2 else []) + piece[:cut]
        docs.append((d, " ".join(own).title() + "."))
    want = {}
    for d, text in docs:
        for i, item in items:
            pattern, own = tokens(item), tokens(text)
            if i is not None and pattern:
                least = min(decontamination.MIN_MATCH, len(pattern))
                n = brute_tiles(pattern, own, least)
                if n >= decontamination.THRESHOLD * len(pattern):
                    want[d, i] = n
    found = decontamination.contaminations(documents(spark, [(d, t, "en") for d, t in docs]), benchmark(spark, items)).collect()
    assert {(x["doc_id"], x["item_id"]): x["n_tokens"] for x in found} == want and len(want) >= 15
    table = decontamination.decontaminate(documents(spark, [(d, t, "en") for d, t in docs]), benchmark(spark, items)).collect()
    assert {x["doc_id"] for x in table if x["contaminated"]} == {d for d, _ in want} and len(table) == len(docs)


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    items = benchmark(spark, [(i, " ".join(words(i, 20, 100))) for i in range(9)])
    docs = documents(spark, [(d, " ".join(words(d % 9, 20, 100)), "en") for d in range(20)])
    whole = sorted(map(tuple, decontamination.contaminations(docs, items).collect()))
    monkeypatch.setattr(decontamination.benchmark_blocks, "__defaults__", (60,))
    assert len(list(decontamination.benchmark_blocks(items))) > 3
    assert sorted(map(tuple, decontamination.contaminations(docs, items).collect())) == whole and len(whole) == 20


def test_decontamination_of_awkward_tables(spark):
    table, items = awkward(spark), benchmark(spark, [(1, "one two"), (2, " ".join(words(5, 40)))])
    found = decontamination.decontaminate(table, items).collect()
    assert {r["doc_id"] for r in found if r["contaminated"]} == {4, 5, 6} and len(found) == table.count() - 1
    assert not any(r["contaminated"] for r in decontamination.decontaminate(table, items.limit(0)).collect())
    assert decontamination.decontaminate(table.limit(0), items).count() == 0


def test_a_word_fifty_thousand_times():
    """Every place of the item shares its seeds with every place of the text; a match is one entry."""
    import tracemalloc

    index = decontamination.Index([(1, "so " * 206), (2, "so " * 100 + " ".join(words(1, 100)))], 5)
    text = decontamination.Index([(0, "so " * 50_000)], 5).tokens
    tracemalloc.start()
    found = decontamination._covered(index, 5, 0.5)
    rows = [tuple(r.values()) for batch in found(iter([pa.record_batch([pa.array([7]), pa.array(["so " * 50_000])], names=["doc_id", "text"])])) for r in batch.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == [(7, 1, 1.0, 206), (7, 2, 0.5, 100)] and len(text) == 50_000
    assert peak < 100 << 20


def test_packing_refuses_tokenizers_that_join_words(spark):
    import public_tokenizers

    with pytest.raises(ValueError):
        packing.pack(documents(spark, [(1, "a b", "en")]), public_tokenizers.path("byte_bpe_50k.json"))


def test_packing_deals_rows_without_id_to_all_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 10)
    rows = packing.pack(documents(spark, [(None, "one two three", "en")] * 60 + [(1, "one two three", "en")] * 60)).collect()
    assert len(rows) == 120
    taken = {}
    for r in rows:
        taken.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in taken.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length


def test_packing_round_trip(spark):
    table = awkward(spark).unionByName(documents(spark, [(100 + i, " ".join(words(i, 30 * i)) + " Don't <|endoftext|> naïve café 12.5!", "en") for i in range(60)]))
    rows = packing.pack(table).collect()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID]) for r in table.collect()]
    want = sorted(
        (-1 if d is None else d, s, len(own[s : s + 2048]), zlib.crc32(np.array(own[s : s + 2048], "<u4").tobytes()), len(own)) for d, own in ids for s in range(0, len(own), 2048)
    )
    assert sorted((-1 if r[0] is None else r[0], *r[1:5]) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0, *(n for _, n in pieces)])[:-1]) and sum(n for _, n in pieces) <= 2048
    assert packing.pack(table.limit(0)).count() == 0


def test_packing_plan_holds_the_histogram_with_little_padding():
    r = np.random.default_rng(0)
    for histogram in ({256: 5}, {1: 3}, {200: 1000, 3: 7}, dict(zip(*map(list, np.unique(r.integers(1, 257, 50_000), return_counts=True))))):
        plan = packing.packing_plan(histogram, 256)
        held = {}
        for shape, n in plan:
            assert sum(shape) <= 256 and n > 0
            for b in shape:
                held[b] = held.get(b, 0) + n
        assert held == histogram
    assert sum(n for _, n in plan) <= 1.005 * sum(b * n for b, n in histogram.items()) / 256


def test_nonnegative_least_squares_meets_its_conditions():
    r = np.random.default_rng(2)
    a, b = r.random((12, 40)), r.random(12) * 5
    x = packing.nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope <= 1e-6).all() and np.allclose(slope[x > 0], 0, atol=1e-6)


PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{margin:0}}</style></head><body class="page-{n}"><header><h2>Site</h2></header>
<nav><ul><li><a href="/a">A</a></li>{menu}</ul></nav><div class="cookie-notice">We use <b>cookies</b></div><script>var t="</p><article>";</script>
<article><h1>Title&nbsp;{n} &amp; more</h1>{body}<div class="ad">Buy now</div><aside>Related</aside><form><p>Sign up</p></form></article>
<section id="comments"><p>Reader {n}</p></section><div class="sidebar">Side</div><footer>&copy; {n}</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "a", "b", "c") for i, u, h in rows], "page_id long, url string, html string, host string, paths string, text string")


def test_main_text_of_a_template(spark):
    rows, want = [], {}
    for n in range(30):
        paragraphs = [f"Par {k} of\n  <i>page</i> {n}<br>line &lt;{k}&gt;" for k in range(n % 5)]
        body = "".join(f"<p>{p}</p>" if k % 2 else f"<p>{p}" for k, p in enumerate(paragraphs))
        rows.append((n, f"https://h{n % 2}.example/{n}", PAGE.format(n=n, menu="<li>M</li>" * (n % 3), body=body)))
        want[n] = "\n".join([f"Title {n} & more", *(f"Par {k} of page {n} line <{k}>" for k in range(n % 5))])
    found = {r["page_id"]: r for r in html_extraction.extract_text(pages(spark, rows)).collect()}
    assert {i: r["text"] for i, r in found.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    wrappers = html_extraction.host_wrappers(pages(spark, rows).select(F.lit("h").alias("host"), "html")).collect()
    assert len(wrappers) == 1 and "(<p>" in wrappers[0]["wrapper"] and ")*" in wrappers[0]["wrapper"]


def test_main_text_without_an_article_element(spark):
    body = "<html><body><div class='menu'><p>Home</p></div><div class='content'>{}</div><div class='footer'>f</div></body></html>"
    rows = [(n, "http://x.example/", body.format("".join(f"<p>Text {k}</p>" for k in range(n)))) for n in range(1, 6)]
    found = {r["page_id"]: r["text"] for r in html_extraction.extract_text(pages(spark, rows)).collect()}
    assert found == {n: "\n".join(f"Text {k}" for k in range(n)) for n in range(1, 6)}


def test_main_text_does_not_depend_on_where_other_pages_keep_theirs(spark):
    rows, want = [], {}
    for n in range(24):
        kind = ("news", "sport", "money")[n % 3]
        url = f"http://two.example/{n}" if n % 4 else None
        if n % 2:
            page = f"<body class='single category-{kind}'><div class='menu'>Home</div><article id='slug-{'abcdefghijklmnopqrstuvwxyz'[n]}'><h1>Head {n}</h1><p>{f'Story {n} ' * 40}</p></article></body>"
            want[n] = f"Head {n}\n" + " ".join([f"Story {n}"] * 40)
        else:
            page = f"<body class='shop category-{kind}'><div class='part-one'><p>First {n} of the parts</p></div><div class='part-two'><p>Second {n}</p></div><div class='footer'>f</div></body>"
            want[n] = f"First {n} of the parts\nSecond {n}"
        rows.append((n, url, page))
    found = {r["page_id"]: r["text"] for r in html_extraction.extract_text(pages(spark, rows)).collect()}
    assert found == want


def test_wrapper_labels_have_shared_words_only(spark):
    rows = [("h", f"<body class='single c{'abcdefgh'[n]}x'><article id='{'klmnopqr'[n]}y'><p>t</p></article></body>") for n in range(8)]
    wrapper = html_extraction.host_wrappers(spark.createDataFrame(rows, "host string, html string")).collect()
    assert [r["wrapper"] for r in wrapper] == ["<body.single> <article> <p> # </p> </article> </body>"]


def test_text_that_all_pages_of_a_host_share_is_template(spark):
    body = "<body><div class='top'><article><p>Own {0} text of this page</p><div>Read this again <b>and</b> again</div><p>More {0}</p></article></div></body>"
    rows = [(n, "http://t.example/", body.format(n)) for n in range(12)]
    rows += [(100 + n, "http://few.example/", body.format(n)) for n in range(5)] + [(200 + n, "http://copies.example/", body.format(7)) for n in range(12)]
    found = {r["page_id"]: r["text"] for r in html_extraction.extract_text(pages(spark, rows)).collect()}
    for i, text in found.items():
        n = 7 if i >= 200 else i % 100
        assert text.split("\n") == [f"Own {n} text of this page", *(["Read this again and again"] if i >= 200 else []), f"More {n}"]


def test_hosts_of_few_and_many_pages_agree(spark):
    """A heading that all articles share stays, a notice in a plain element goes, by the wrapper alone."""
    body = "<body><article><h1>Dish {0}</h1><p>Take {0} eggs</p><h2>Ingredients</h2><p>Salt {0}</p><div>Join our club today</div></article></body>"
    for n_pages in (3, 9, 12):
        rows = [(n, "http://r.example/", body.format(n)) for n in range(n_pages)]
        found = {r["page_id"]: r["text"] for r in html_extraction.extract_text(pages(spark, rows)).collect()}
        assert found == {n: f"Dish {n}\nTake {n} eggs\nIngredients\nSalt {n}" for n in range(n_pages)}
    reader = html_extraction.Reader()
    assert html_extraction.main_text(reader, body.format(1)).endswith("Join our club today")


def plain_alignment(a, b):
    """The same recurrence with a whole table."""
    same = lambda x, y: html_extraction._same(x, y)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if same(a[i], b[j]) else max(best[i + 1][j], best[i][j + 1])
    return best


def test_alignment_rows_equal_a_whole_table():
    r = random.Random(8)
    for _ in range(60):
        a, b = ([r.choice(["p", "/p", "b", ("+", ("p", "/p")), ("?", ("b",)), "i"]) for _ in range(r.randint(0, 30))] for _ in range(2))
        rows, whole = html_extraction.CommonItems(a, b), plain_alignment(a, b)
        for i in [*range(len(a) + 1), *(r.randrange(len(a) + 1) for _ in range(9))]:
            assert rows.row(i).tolist() == whole[i]


def test_alignment_of_very_long_streams_takes_little_memory():
    r = random.Random(9)
    tags = [f"t{k}" for k in range(400)]
    a = [r.choice(tags) for _ in range(20_000)]
    b = [x for x in a if r.random() < 0.9]
    rows = html_extraction.CommonItems(a, b)
    held = sum(x.nbytes for x in rows.kept.values())
    assert rows.row(0)[0] == len(b) and held < 20_000_000


STORY = "<p>The story {0} goes on here for a while</p>"


@pytest.mark.parametrize("page", [
    "<body><div class='layout has-sidebar'><article>{0}</article></div></body>",
    "<body><main class='no-sidebar'>{0}</main></body>",
    "<body><article class='post comments-open'>{0}</article><div class='post-comments'><article class='x'>Reader</article></div></body>",
    "<body><form id='aspnetForm'><div class='nav'>Home</div><div>{0}</div></form></body>",
    "<body><article><section class='social-history'>{0}</section></article></body>",
    "<body><article><div id='related-work'>{0}</div><div class='related-articles'>Other</div></article></body>",
    "<body><article><div class='lead ad-free'>{0}</div><div class='ad-slot'>Buy</div></article></body>",
    "<body><div class='site-header'>Site</div><article><div class='article-header'>{0}</div><div class='share-buttons'>Send</div></article></body>",
    "<body><header><h2>Site</h2></header><article><header>{0}</header></article></body>",
    "<body><div class='sidebar'><div class='box'>{0}</div></div></body>",
    "<body><div class='teasers'><article>T</article></div><div class='text'>{0}{0}{0}</div></body>",
    "<body><div class='cookie-bar'>We use cookies</div><div class='main-nav'>A</div><div id='newsletter_signup'>Mail</div>{0}</body>",
])
def test_names_do_not_hide_the_article(page):
    own = html_extraction.main_text(html_extraction.Reader(), page.format(STORY.format(1)))
    line = "The story 1 goes on here for a while"
    assert own in (line, "T\n" + "\n".join([line] * 3))


def test_a_button_does_not_break_its_paragraph():
    page = "<article><p>Before <button>Copy</button> and after</p><p>Next<select><option>1</select></p></article>"
    assert html_extraction.main_text(html_extraction.Reader(), page) == "Before and after\nNext"


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "no host", ""), (3, "http://x.example", "<p>a <b>b"), (3, "http://x.example", "<p>a <b>b"), (None, "http://x.example", "plain < text & more"),
            (4, "http://y.example", "<article><p>" + "long " * 50_000 + "</p><!-- open"), (5, "http://z.example", "<a href='x>y\" <<p>>q")]
    found = html_extraction.extract_text(pages(spark, rows)).collect()
    by_id = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and by_id[1] == by_id[2] == "" and by_id[3] == "a b" and by_id[None] == "plain < text & more"
    assert len(by_id[4]) == 5 * 50_000 - 1
    assert html_extraction.extract_text(pages(spark, rows).limit(0)).count() == 0


def test_wrapper_reads_optional_and_repeated_groups():
    streams = [["h1", "p", "/p"], ["h1", ("+", ("p", "/p"))], ["h1", "hr", "p", "/p"], ["h1"]]
    assert html_extraction.wrapper_text(html_extraction.infer(streams)) == "<h1> (<hr>)? (<p> </p>)*"
    assert html_extraction.fold(list("abababx")) == [("+", ("a", "b")), "x"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents, labels and benchmark in a folder of their own."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    r = random.Random(8)
    item = " ".join(words(77, 25, 2000))
    rows = []
    for i in range(150):
        w = words(i % 120, 60, 2000)
        text = " ".join(w[:30]) + ".\n" + " ".join(w[30:])
        if i % 10 == 0:
            text = " ".join(f"{x.upper()}##" for x in w)
        if i % 17 == 3:
            text += "\n" + item + "\nAnd more of it."
        if i % 7 == 2:
            text += "\nThis line comes again and again in the texts\n"
        rows.append((i, text, "en"))
    rows += [(900, None, "en"), (901, "", None)]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 10 > 0), 0, "c") for i in range(150)], LABELS).write.parquet(f"{folder}/labels.parquet")
    benchmark(spark, [(1, item), (2, "not in any text at all here")]).write.parquet(f"{folder}/benchmark.parquet")
    return folder, item


def test_near_duplicates_of_the_pipeline_share_four_fifths(spark):
    own = [f"u{k}" for k in range(100)]
    texts = {1: own, 2: [*own[:90], *(f"v{k}" for k in range(10))], 3: [f"x{k}" for k in range(100)], 4: [*(f"x{k}" for k in range(86)), *(f"y{k}" for k in range(14))]}
    shingles = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in texts.items()}
    alike = [len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b]) for a, b in ((1, 2), (3, 4))]
    assert 0.81 < alike[0] < 0.84 and alike[1] < 0.8
    docs = documents(spark, [(i, " ".join(w), "en") for i, w in texts.items()])
    stage = dict(corpus_pipeline.STAGES)["minhash_dedup"]
    assert {r["doc_id"] for r in stage(spark, docs, "").collect()} == {1, 3, 4}


def test_banding_follows_the_threshold():
    missed = {p: 1 - (1 - (1 - (p / 100) ** minhash_dedup.HALF) ** minhash_dedup.sides(p)) ** 2 for p in (60, 70, 80, 84)}
    assert all(m <= 0.0003 for m in missed.values()) and minhash_dedup.sides(85) == minhash_dedup.SIDE


def test_stages_on_all_rows_of_their_predecessors(spark, corpus):
    folder, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "minhash_dedup", "substring_dedup", "decontamination", "packing"]
    state = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert out.columns == columns
        found = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "quality":
            scored = quality.quality(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
            assert set(found) == {r["doc_id"] for r in scored if r["predicted"]} and all(found[i] == state[i] for i in found)
            assert not any(i % 10 == 0 for i in found if i < 150) and len(found) > 0.8 * 135
        elif name == "minhash_dedup":
            assert set(found) == {i for i, (_, _, kept) in brute_minhash(list(state.items())).items() if kept}
        elif name == "substring_dedup":
            assert found == {i: text for i, (text, _) in brute_repeats(list(state.items())).items()}
        else:
            assert set(found) == {i for i, t in state.items() if brute_tiles(tokens(item), tokens(t), 5) < 0.5 * len(tokens(item))}
        docs, state = out, found
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in packed} == set(state)
    whole = {(r["doc_id"], r["start"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in packed}
