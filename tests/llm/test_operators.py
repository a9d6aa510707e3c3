"""Each operator against a plain version of it, with nulls, empty texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from claimlode.llm import chat, common, jaccard, mixing, neighbours, packing, pages, quality, repeats, sketches, urls

DOCS = "doc_id long, text string, source string, length long, size long, n_chars long"
WORDS = [f"w{i}" for i in range(400)]


def make_docs(spark, n=40, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(WORDS, k=rng.choice([1, 3, 6, 40, 90, 200])))
        rows.append((i, text, rng.choice(["a", "b", None])))
    base = rows[7][1] + " " + " ".join(rng.choices(WORDS, k=150))
    near = base.split()
    near[20] = "other"
    rows += [(n, base, "a"), (n + 1, base, "b"), (n + 2, " ".join(near), "a"), (n + 3, None, "a"), (n + 4, "", None)]
    rows += [(n + 5, " \n\t", "b"), (n + 6, "ß" * 700, "c"), (n + 7, "The " * 900, "c"), (n + 8, base[50:700] + "ü" + base[90:500], "c")]
    rows += [(5, rows[5][1], rows[5][2]), (None, "no id here", "a")]
    return spark.createDataFrame([(a, b, c, 1, 2, 3) for a, b, c in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return make_docs(spark).cache()


def test_packing_is_gapless_whole_and_tight(spark, docs):
    rows = packing.pack_documents(docs, capacity=128).collect()
    want = sum(len(packing.byte_bpe()(r.text or "")) + 1 for r in docs.collect())
    assert sum(r.length for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert len(sequences) <= -(-want // 128) * 1.05 + 1


def test_both_encoders_agree(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", " a  b\n\n c", "naïve 12345 ßü 漢字　x", "don't STOP!!", *(r.text or "" for r in docs.collect())]:
        assert packing.byte_bpe()(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_added_tokens_have_their_own_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.byte_bpe()("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    for text in ["<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext|", "<|ENDOFTEXT|>", "ß " * 900 + "<|endoftext|>"]:
        assert packing.byte_bpe()(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_best_two_fit_replaces_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[7, 2, 1]] = 1, 1, 2  # 7 + 2 leaves a gap of 1; the piece of 2 cannot be bettered
    assert packing.fill_plan(counts, 10)[0] == ({7: 1, 2: 1, 1: 1}, 1)
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = 1, 1, 2  # 6 + 3 leaves 1: two pieces of 2 fill the gap of 4
    assert packing.fill_plan(counts, 10)[0] == ({6: 1, 2: 2}, 1)


def plain_bins(lengths, capacity):
    """Best-two-fit, one piece after the other."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        rest, held, room = list(left), [], capacity
        while fitting := [x for x in rest if x <= room]:
            rest.remove(fitting[0])
            held.append(fitting[0])
            room -= fitting[0]
        smallest = min(held)
        pairs = [(a + b, -a) for i, a in enumerate(rest) for b in rest[i + 1 :] if smallest < a + b <= room + smallest]
        if room and pairs:
            total, larger = max(pairs)
            held.remove(smallest)
            held += [-larger, total + larger]
        for x in held:
            left.remove(x)
        bins.append(sorted(held))
    return sorted(bins)


def test_plan_of_counts_equals_piece_by_piece():
    rng = np.random.default_rng(11)
    for _ in range(300):
        capacity = int(rng.integers(3, 25))
        lengths = rng.integers(1, capacity + 1, rng.integers(0, 40)).tolist()
        plan = packing.fill_plan(np.bincount(lengths, minlength=capacity + 1), capacity)
        bins = [sorted(Counter(items).elements()) for items, repeats in plan for _ in range(repeats)]
        assert sorted(bins) == plain_bins(lengths, capacity), (capacity, sorted(lengths))


def test_targets_share_out_all_and_stop_at_three_times():
    out = mixing.targets([100, 10, 1000], [1, 2, 3])
    assert out[1] == 30 and sum(out) == pytest.approx(1110) and out[2] == pytest.approx(3 * out[0])
    assert mixing.targets([], []) == []


def test_mix(spark, docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = {(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()}
    assert {(r.doc_id, r["size"]) for r in rows} == sizes
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert sum({(r.source_size, r.target) for r in rows} and {r.target for r in rows}) == pytest.approx(sum(r["size"] for r in rows), rel=0.5)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in rows)


def plain_sets(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(low))
        yield {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("block", [4096, 2])
def test_jaccard_components(spark, docs, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    monkeypatch.setattr(jaccard, "ROOM_SHINGLES", 64 if block == 2 else 1 << 18)
    rng = random.Random(9)
    base = rng.choices(WORDS, k=120)
    rows = []
    for i in range(30):  # a chain of near copies, each alike to the next only
        base = list(base)
        base[rng.randrange(120)] = f"n{i}"
        base[rng.randrange(120)] = f"m{i}"
        rows.append((1000 + i, " ".join(base), "z", 1, 2, 3))
    every = docs.where("doc_id IS NOT NULL").unionByName(spark.createDataFrame(rows, DOCS))
    all_rows = every.collect()
    sets = list(plain_sets(all_rows))
    parent = {r.doc_id: r.doc_id for r in all_rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= 75 * len(a | sets[j]):
                x, y = root(all_rows[i].doc_id), root(all_rows[j].doc_id)
                parent[max(x, y)] = min(x, y)
    want = sorted((r.doc_id, len(s), root(r.doc_id)) for r, s in zip(all_rows, sets, strict=True))
    assert sorted(map(tuple, jaccard.jaccard_components(every).collect())) == want
    kept = jaccard.one_of_each(every)
    assert kept.columns == every.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def plain_removal(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    for t in texts:
        hit = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                hit[i] += 1
                hit[i + length] -= 1
        gone = np.cumsum(hit)[: len(t)] > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        yield len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("length", "gram", "hot"), [(60, 16, 20_000), (60, 16, 1), (33, 8, 20_000)])
def test_repeated_strings(docs, length, gram, hot):
    rows = docs.collect()
    want = plain_removal([(r.text or "").encode() for r in rows], length)
    want = sorted((str(r.doc_id), *w) for r, w in zip(rows, want, strict=True))
    got = repeats.removal_report(docs, length, gram, hot).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_without_repeats_keeps_rows_and_whole_characters(docs):
    out = repeats.without_repeats(docs, 60, 16)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("n_chars <> length(text)").count() == 0


def test_hash_collisions_are_found_out():
    # with base 1 a hash is a sum of bytes, so texts of the same letters collide
    texts = [b"anchorabcdef", b"anchorbadcfe", b"anchorbadcfe"]
    found = repeats.covered_fragments(np.zeros(3, int), texts, np.zeros(3, int), 10, bases=(1, *repeats._BASES))
    assert set(found) == {(1, 0, 12), (2, 0, 12)}


def plain_sketch(text, scale=sketches.SCALE):
    """Shingle hashes below the fixed fraction, and the smallest, as signed numbers in order."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = set()
    for i in range(max(len(words) - 4, min(len(words), 1))):
        seed = 42
        for word in words[i : i + 5]:
            seed = xxhash.xxh64(word.encode(), seed=seed).intdigest()
        hashes.add(seed - (1 << 64) if seed >> 63 else seed)
    return sorted(h for h in hashes if h < -(1 << 63) + (1 << 64) // scale or h == min(hashes))


def plain_containment(one, other):
    if not one or not other:
        return float(one == other)
    return len({*one} & {*other}) / min(len(one), len(other))


def test_sketches(spark, docs):
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = {r.doc_id: r for r in sketches.edited_fingerprints(docs).collect()}
    texts = {r.doc_id: r.text or "" for r in rows}
    ids = list(dict.fromkeys(r.doc_id for r in rows))
    for here, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        quarter = len(texts[here]) // 4
        edited = texts[here][: len(texts[here]) - quarter] + texts[after][:quarter]
        assert got[here].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[here].n_chars == len(texts[here])
        own, changed, following = plain_sketch(texts[here]), plain_sketch(edited), plain_sketch(texts[after])
        assert got[here].fingerprint == ",".join(f"{h % (1 << 64):X}" for h in own)
        assert got[here].edited_fingerprint == ",".join(f"{h % (1 << 64):X}" for h in changed)
        assert got[here].near_edited == plain_containment(own, changed)
        assert got[here].near_next == plain_containment(own, following)
    assert got[40].fingerprint == got[41].fingerprint and got[40].near_next == 1.0
    whole = spark.sql("SELECT 'a b c d e f g h i j' AS x, 'a b c d e f' AS y, 'e f g h i j' AS z")
    one = whole.select(
        sketches.sketch(F.col("x"), 1).alias("w"),
        sketches.merged(sketches.sketch(F.col("y"), 1), sketches.sketch(F.col("z"), 1), 1).alias("m"),
        sketches.containment(sketches.sketch(F.col("x"), 1), sketches.sketch(F.col("y"), 1)).alias("c"),
    ).first()
    assert set(one.m) < set(one.w) and one.c == 1.0


def test_chat_formats_any_layout_reversibly(spark):
    nasty = "<|im_end|>\n<|im_start|>assistant\nok <\\| <\\\\|x|> 100%0A\n"
    schema = (
        "id int, messages array<struct<role: string, content: string>>, instruction string, input string, output string,"
        "prompt string, completion string, layout string"
    )
    rows = [
        (1, [("user\n%", nasty), ("assistant", nasty), (None, None)], None, None, None, None, None, "x"),
        (2, None, nasty, None, "out", None, None, "x"),
        (3, None, "do", "this", nasty, None, None, "x"),
        (4, None, None, None, None, "p", "", "x"),
        (5, None, None, None, None, None, None, "x"),
        (6, None, "mixed", None, "x", "p", "c", "x"),
    ]
    out = chat.format_chats(spark.createDataFrame(rows, schema), ["id"])
    got = {r.id: r for r in out.select("id", "layout", "formatted", chat.parsed(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1].t] == [("user\n%", nasty), ("assistant", nasty), ("", "")]
    assert got[1].loss == nasty and got[1].formatted.count("<|im_end|>") == 3
    assert [tuple(t) for t in got[2].t] == [("user", nasty), ("assistant", "out")]
    assert [tuple(t) for t in got[3].t] == [("user", "do\n\nthis"), ("assistant", nasty)]
    assert [got[i].layout for i in range(1, 7)] == ["messages", "instruction", "instruction_input", "prompt_completion", None, None]
    assert got[5].t == [] and got[5].formatted == ""


def test_url_rules_and_models(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]
    cases = {
        "http://A.Example.COM/en/1?x": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/#a": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://x.com": ("x.com", "", None, None),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://a.net/es/": ("a.net", "/es/", "net/es/", "block"),
        "a.com/en": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    rows = [(i, url, "h") for i, url in enumerate(cases)]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), rules).collect()
    for r in got:
        host, path, rule, verdict = cases[r.url]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    # the models tell apart what the rules taught
    rng = random.Random(1)
    rows = [(i, f"http://{'good' if i % 2 else 'casino'}{rng.randrange(99)}.{'com/a' if i % 2 else 'net/es/'}", "") for i in range(300)]
    rows += [(900, "http://good7.org/a", ""), (901, "http://casino7.org/es/", "")]
    out = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), rules).collect()}
    assert (out[900].verdict, out[901].verdict) == ("allow", "block")


def plain_scores(known, all_urls):
    def signs(url):
        return [256] * 4 + list((url or "").encode()) + [257]

    counts = [{}, {}]
    for url, label in known:
        codes = signs(url)
        for i in range(4, len(codes)):
            for order in range(1, 6):
                for key in (("gram", *codes[i - order + 1 : i + 1]), ("context", *codes[i - order + 1 : i])):
                    key = (order, *key)
                    counts[label][key] = counts[label].get(key, 0) + 1
    for url in all_urls:
        codes, total = signs(url), 0.0
        for i in range(4, len(codes)):
            for label, sign in ((1, 1), (0, -1)):
                chance = 1 / 258
                for order in range(1, 6):
                    seen = counts[label].get((order, "gram", *codes[i - order + 1 : i + 1]), 0)
                    base = counts[label].get((order, "context", *codes[i - order + 1 : i]), 0)
                    chance = (seen + urls.SMOOTHING * chance) / (base + urls.SMOOTHING)
                total += sign * np.log(chance)
        yield total / (len(codes) - 4)


def test_url_models_count_every_n_gram_of_every_url_with_a_rule(spark, monkeypatch):
    monkeypatch.setattr(urls, "CHUNK", 64, raising=False)
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789ü"
    rows = [(i, f"http://{'ab'[i % 2]}.{['com', 'net', 'org'][i % 3]}/" + "".join(rng.choices(letters, k=60))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "x"), (403, "http://a.com/" + "y" * 3000), *[(i, rows[0][1]) for i in range(404, 500)], (404, rows[0][1])]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.filter_urls(frame, [("allow", "com/"), ("block", "net/")]).collect()
    assert sorted((r.page_id, r.url or "") for r in got) == sorted((i, url or "") for i, url in rows)
    known = [(r.url, int(r.verdict == "allow")) for r in got if r.rule]
    want = list(plain_scores(known, [r.url for r in got]))
    assert np.allclose([r.score for r in got], want, rtol=0, atol=1e-9)


def test_page_regions():
    weights = {"word": 3.0, "other": -0.1}
    html = (
        "<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav>a b</nav><div id='cookie-notice'>We</div>"
        "<main><article><header><h1>Title</h1></header><p>One <a href=x>two</a>&nbsp;&lt;3<br>four<p>Five<script>x('</p>')</script>"
        "<aside>side</aside><ul><li>x<li>y</ul><form>Mail<input></form><section class='comments'><p>nice</p></section></article></main>"
        "<footer>f</footer>"
    )
    assert pages.main_text(html, weights) == "Title\nOne two <3 four\nFive\nx\ny"
    for empty in (None, "", "<nav>x", "<div class='ad'>x</div>", "<script>"):
        assert pages.main_text(empty, weights) == ""
    assert pages.main_text("plain &amp; simple", weights) == "plain & simple"
    assert pages.region([-1, 2, 0, 3, -9, 4]) == (1, 4)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><p class='ad'>Buy<p>One<p>Two</article><p>out", "One\nTwo"),
        ("<article><p class=ad>Buy<div>One</div><p class=ad>Buy<p class=ad>Buy<h2>Two</h2></article>", "One\nTwo"),
        ("<article><ul><li class='share'>x<ul><li>y</ul><li>One<li class=share>z</ul><p>Two</article>", "One\nTwo"),
        ("<article><dl><dt class=ad>x<dd>One<dd class=ad>y</dl>Two</article>", "One\nTwo"),
        ("<article><table><tr><td class=ad>x<td>One<tr class=ad><td>y<td>z<tr><td>Two</table>Three</article>", "One\nTwo\nThree"),
        ("<article><table><tr><td>One<td class=ad>x<table><tr><td>y</table>z</table>Two</article>", "One\nTwo"),
        ("<article><div><p class=ad>Buy <span>now</div>One</article>", "One"),
        ("<article><p class=ad>Buy <b>now</i></p>One</article>", "One"),
        ("<article>One<div class=ad>x<div>y</div><p>z</div>Two<section><div class=ad>x</section>Three</article>", "One\nTwo\nThree"),
        ("<article>One one<p class=ad>x</article><div>out</div><article>Two</article>", "One one\nTwo"),
        ("<html><head><meta charset=x><title>t</title><body><p>One", "One"),
    ],
)
def test_left_out_elements_without_end_tag(html, want):
    assert pages.main_text(html, {"word": 3.0, "other": -0.1}) == want


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<div class='content no-sidebar'><p>One</p></div>", "One"),
        ("<div class='has-sidebar'><p>One</p></div>", "One"),
        ("<div class='row with-sidebar-left'><p>One</p></div>", "One"),
        ("<article class='post no-comments tags-x'><p>One</p></article>", "One"),
        ("<article class='post comments'><p>One</p></article>", "One"),
        ("<article><header class='entry-header'><h1>Title</h1></header><p>One</article>", "Title\nOne"),
        ("<article><div class='page-header'><h1>Title</h1></div><p>One</article>", "Title\nOne"),
        ("<div class='content sidebar'><p>One two three</p><div class='sidebar'>x</div></div>", "One two three"),
        ("<p>One two three</p><div class='row sidebar'>x y</div>", "One two three"),
        ("<article>One two<div class='related wrapper'>x</div></article>", "One two"),
        ("<div class='container sidebar'><article>One</article></div>", "One"),
        ("<div id=site-header>x</div><p>One<div class='ad-banner'>x</div><div class='box comments-list'>x</div>", "One"),
        ("<article>One<div class='social-share'>x</div><article class=comment>x</article><div aria-label='Related posts'>x</div></article>", "One"),
        ("<p>One<div class=post data-id='ad'>Two</div>", "One\nTwo"),
        ("<article hidden>x</article><p>One", "One"),
        ("<div class=entry-header><h1>Title</h1></div><p>One<div class=post-comments>x</div>", "Title\nOne"),
        ("<div class=content-sidebar-wrap><p>One</div>", "One"),
    ],
)
def test_names_beside_the_article_are_whole(html, want):
    assert pages.main_text(html, {"word": 3.0, "other": -0.1}) == want


def test_region_equals_trying_all_runs():
    rng = np.random.default_rng(6)
    for _ in range(300):
        scores = rng.integers(-4, 4, rng.integers(0, 12)).tolist()
        runs = [(i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        best = max([0, *(sum(scores[i:j]) for i, j in runs)])
        start, stop = pages.region(scores)
        assert sum(scores[start:stop]) == best


#: Fixture: names of words, so that articles differ; menus and notices before and after, articles of all sizes.
def marked_page(rng, article: str) -> str:
    words = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 500, n))
    menu = "".join(f"<li><a href=/{i}>{words(1)}</a></li>" for i in range(rng.integers(3, 9)))
    side = "".join(f"<li><a href=/{i}>{words(4)}</a>" for i in range(rng.integers(2, 6)))
    return (
        f"<html><head><title>{words(3)}</title></head><body><nav><ul>{menu}</ul></nav><div class=ad>{words(rng.integers(3, 15))}</div>"
        f"<{article}><h1>{words(5)}</h1>" + "".join(f"<p>{words(rng.integers(10, 60))}" for _ in range(rng.integers(1, 12))) + f"</{article}>"
        f"<div class='box related'><ul>{side}</ul></div><footer>&copy; {words(rng.integers(4, 20))}</footer></body></html>"
    )


def word_f1(got: str, want: str) -> float:
    both = sum((Counter(got.split()) & Counter(want.split())).values())
    return 2 * both / (len(got.split()) + len(want.split())) if both else 0.0


def test_scan_finds_unmarked_articles_without_lists(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, "u", marked_page(rng, "article")) for i in range(300)]
    weights = pages.learn_weights(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert weights["word"] > 0 and max(value for kind, value in weights.items() if kind != "word") < 0
    plain = [marked_page(rng, "section") for _ in range(100)]
    want = [pages.main_text(html.replace("<section>", "<article>").replace("</section>", "</article>"), weights) for html in plain]
    assert all(want)
    monkeypatch.setattr(pages, "BESIDE", frozenset())
    monkeypatch.setattr(pages, "LEFT_OUT", frozenset(["head"]))
    got = [pages.main_text(html, weights) for html in plain]
    assert np.mean([word_f1(a, b) for a, b in zip(got, want, strict=True)]) >= 0.95


def test_scan_finds_unmarked_articles_of_the_given_pages(spark, monkeypatch):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = pages.learn_weights(given)
    html = [r.html for r in given.collect()]
    want = [pages.main_text(one, weights) for one in html]
    monkeypatch.setattr(pages, "BESIDE", frozenset())
    monkeypatch.setattr(pages, "LEFT_OUT", frozenset(["head"]))
    got = [pages.main_text(re.sub("(</?)article", r"\1section", one), weights) for one in html]
    assert np.mean([word_f1(a, b) for a, b in zip(got, want, strict=True)]) >= 0.95


def test_marked_text_is_whole():
    weights = pages.complete({"li": -9.0, "a": -9.0, "nav": -7.0, "nav/li": -9.0, "div": -8.0}, 0.02)
    cells = "".join(f"<tr><td>{c}</td></tr>" for c in "abcdefghijklmnopqrstuvwxyzabcd")
    listed = "".join(f"<li><a href=x>{c}</a></li>" for c in "abcdefghij")
    body = f"<p>{'long ' * 200}</p><table>{cells}</table><ul>{listed}</ul><nav><ul><li>menu</ul></nav><p>The close"
    text = pages.main_text(f"<nav><ul><li>x</ul></nav><article>{body}</article><div>out</div>", weights).split("\n")
    assert text == [" ".join(["long"] * 200), *"abcdefghijklmnopqrstuvwxyzabcd", *"abcdefghij", "The close"]
    assert pages.main_text("<article><p>One</p></article><article><p>Two</p></article>", weights) == "One\nTwo"


def test_adaptive_scan_finds_the_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 32)).astype(np.float32)
    x[50:80] = x[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, [1.0], 1), (904, [None] * 32, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = neighbours.nearest(table, table.where("vec_id % 100 = 0"), k=10, share=1.0).collect()
    hits = 0
    for q in (0, 100, 200, 300):
        distance = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(400), distance)) if i != q][:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        hits += len({r.vec_id for r in mine} & set(order))
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(r.score == pytest.approx(distance[r.vec_id], abs=1e-12) for r in mine)
        if q == 0:
            assert [r.vec_id for r in mine] == order
    assert hits >= 36 and {r.query_id for r in got} == {0, 100, 200, 300}


def test_line_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    emit, follow = rng.normal(size=5), rng.normal(size=(2, 2))
    good, pairs = quality.marginals(emit, np.zeros(5, int), follow)
    total, want = 0.0, np.zeros(5)
    for code in range(32):
        y = np.array([code >> i & 1 for i in range(5)])
        weight = np.exp((emit * y).sum() + follow[y[:-1], y[1:]].sum())
        total += weight
        want += weight * y
    assert good == pytest.approx(want / total)
    assert pairs.sum() == pytest.approx(4)


def test_quality_learns_and_scores_every_row(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(WORDS, k=30)
        text = "\n".join(" ".join(w + ("%%%" if i % 4 == 0 else "") for w in words[j : j + 10]) for j in (0, 10, 20))
        rows.append((i, text, "s", 1, 2, 3))
        labels.append((i, int(i % 4 != 0), 0))
    rows += [(500, None, "s", 1, 2, 3), (501, "", "s", 1, 2, 3), (None, " \n ", "s", 1, 2, 3)]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs, known).collect()
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert len(got) == 303 and len(held) > 60
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    assert all(0 <= r.score <= 1 for r in got)
    assert quality.good_documents(docs, known).columns == docs.columns
    assert {r.score for r in quality.score_documents(docs, known.where("false")).collect()} == {0.5}


def traced_peak(work) -> int:
    """Bytes that the work held at most beyond what there was before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def long_batch() -> pa.RecordBatch:
    """Two megabytes of text in 600 rows."""
    rng = random.Random(9)
    texts = ["\n".join(" ".join(rng.choices(WORDS, k=12)) for _ in range(50)) for _ in range(600)]
    texts = [text[: (2 << 20) // 600] for text in texts]
    ids = pa.array(range(len(texts)), pa.int64())
    return pa.record_batch([ids, ids, pa.array(texts)], names=["doc", "doc_id", "text"])


def test_scoring_holds_little_memory(spark):
    text = long_batch().column("text")
    assert text.nbytes > 1_000_000
    rng = np.random.default_rng(1)
    width = 3 * quality.OWN_FEATURES + 2
    model = quality.Model(np.zeros(width), np.ones(width), rng.normal(size=width), 0.1, rng.normal(size=(2, 2)), 0.5)
    score = quality.scorer(model).func
    assert traced_peak(lambda: score(text)) < 30 * text.nbytes
    alone = [score(text.slice(i, 1))[0].as_py() for i in range(0, len(text), 50)]
    assert score(text).take(pa.array(range(0, len(text), 50))).to_pylist() == pytest.approx(alone, abs=1e-12)


def test_anchors_hold_little_memory():
    batch = long_batch()
    rows = lambda part: [r for b in repeats.anchor_rows(part, 400, 64, repeats.utf8) for r in b.to_pylist()]
    peak = traced_peak(lambda: [b.num_rows for b in repeats.anchor_rows(batch, 400, 64, repeats.utf8)])
    assert peak < 40 * batch.column("text").nbytes
    assert rows(batch) == [r for i in range(batch.num_rows) for r in rows(batch.slice(i, 1))]


def test_empty_tables(spark, docs):
    none = docs.where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for frame in (
        packing.pack_documents(none),
        mixing.mix(none),
        jaccard.jaccard_components(none),
        repeats.removal_report(none),
        sketches.edited_fingerprints(none),
        quality.score_documents(none, labels),
        neighbours.nearest(vectors, vectors),
        urls.filter_urls(spark.createDataFrame([], "page_id long, url string"), [("allow", "com/")]),
        pages.extract_text(spark.createDataFrame([], "page_id long, url string, html string")),
        chat.grouped_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
    ):
        assert frame.collect() == []


def test_leaf_pairs_equal_plain_bounds():
    rng = np.random.default_rng(5)
    rows = []
    for head in range(12):
        for _ in range(rng.integers(1, 9)):
            n = int(rng.integers(1, 40))
            width = int(jaccard.groups(np.array([n]))[0])
            counts = np.bincount(rng.integers(0, width, n), minlength=width).astype(np.uint8)
            rows.append((head, len(rows), int(rng.integers(0, 3)), n, counts.tobytes()))
    names = ["head", "node", "label", "n", "counts"]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=names)
    want = set()
    for i, (head, a, label, n, x) in enumerate(rows):
        for other, b, mark, m, y in rows[i + 1 :]:
            w = min(len(x), len(y))
            near = 100 * min(n, m) >= 50 * max(n, m)
            if head == other and label != mark and near:
                bound = np.minimum(jaccard.vector(x, w), jaccard.vector(y, w)).sum()
                if bound >= jaccard.required(np.array(n), np.array(m), 50):
                    want.add((a, b))
    parts = [batch.slice(0, 0), batch.slice(0, 7), batch.slice(7, 1), batch.slice(8)]
    whole = list(jaccard.whole_stars(iter(parts)))
    assert sum(b.num_rows for b in whole) == len(rows) and want
    found = [jaccard.leaf_pairs(b, 50) for b in whole]
    pairs = [p for b in found for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)]
    assert sorted(pairs) == sorted(want)


@pytest.mark.parametrize(("n", "m", "cells"), [(1, 1, 1 << 20), (9, 1, 1 << 20), (700, 90, 1 << 20), (300, 300, 64)])
def test_tree_join_equals_plain_bounds(monkeypatch, n, m, cells):
    monkeypatch.setattr(jaccard, "PAIR_CELLS", cells)
    rng = np.random.default_rng(n)
    kinds = rng.integers(0, 4, (6, 16))  # points near each other, as sets of one passage are

    def points(k):
        label = rng.integers(0, 6, k)
        counts = (kinds[rng.integers(0, 6, k)] + (rng.random((k, 16)) < 0.1)).astype(np.int32)
        return counts, counts.sum(1).astype(np.int64), label

    (p, sizes, label), (q, sizes2, label2) = points(n), points(m)
    bound = np.minimum(p[:, None], q).sum(-1)
    over = bound - jaccard.required(sizes[:, None], sizes2, 75)
    near = 100 * np.minimum(sizes[:, None], sizes2) >= 75 * np.maximum(sizes[:, None], sizes2)
    want = np.argwhere((over >= 0) & near & (label[:, None] != label2))
    one, other = jaccard.Tree(p, sizes, label), jaccard.Tree(q, sizes2, label2)
    assert len(one.levels[-1][1]) == len(other.levels[-1][1]) == 1
    found = [row for part in one.join(other, 75) for row in zip(*part, strict=True)]
    assert sorted((i, j) for i, j, _ in found) == sorted(map(tuple, want))
    assert all(bound_over == over[i, j] for i, j, bound_over in found)


@pytest.mark.parametrize("limit", [4096, 3])
def test_blocks_name_each_set_with_the_smallest_one(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", limit)
    rng = random.Random(2)
    sets = [(i * 7 - 90, [-5, *rng.sample(range(60), 3)] if i % 2 else rng.sample(range(60), 4)) for i in range(40)] + [(999, [])]
    heads = {t: min(node for node, first in sets if t in first) for t in range(-5, 60) if any(t in first for _, first in sets)}
    want = {(heads[t], node) for node, first in sets for t in first if heads[t] != node}
    frame = spark.createDataFrame(sets, "node long, first array<long>")
    assert {tuple(r) for r in jaccard.blocks(frame).collect()} == want


def test_places_put_common_shingles_last():
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 60).astype(np.uint64)).reshape(3, 20)
    level = np.random.default_rng(2).integers(0, 4, 1 << jaccard.COMMON_BITS).astype(np.uint8)
    row = np.repeat(np.arange(3), 20)
    found = jaccard.places(hashes.ravel(), row, np.full(3, 20), level).reshape(3, 20)
    for one, place in zip(hashes, found, strict=True):
        order = sorted(range(20), key=lambda i: (level[jaccard.bucket(one[i : i + 1])[0]], one[i]))
        assert [int(place[i]) for i in order] == list(range(20))


def test_a_passage_of_many_texts_is_common_in_full_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_BITS", 8)
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(100)) + (" " + passage if i < 40 else "") for i in range(400)]
    level = jaccard.commonness(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    # about 150 rare shingles in every bucket, 40 copies of the passage in some
    shared, rare = (jaccard.text_sets(pa.array([text]))[0] for text in (passage, texts[-1]))
    alone = [b for b in jaccard.bucket(shared).tolist() if jaccard.bucket(shared).tolist().count(b) == 1]
    assert np.mean(level[alone] > 0) > 0.9
    assert np.mean(level[jaccard.bucket(rare)] == 0) > 0.6


def test_blocks_are_named_in_any_ranges_of_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SECTION_SHINGLES", 7)
    monkeypatch.setattr(jaccard, "DEALT_SHINGLES", 5)
    rng = random.Random(3)
    every = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(50)]
    sets = [(rng.randrange(-(1 << 63), 1 << 63), rng.sample(every, 4)) for _ in range(60)] + [(0, [])]
    heads = {t: min(node for node, first in sets if t in first) for t in every if any(t in first for _, first in sets)}
    want = {(heads[t], node) for node, first in sets for t in first if heads[t] != node}
    frame = spark.createDataFrame(sets, "node long, first array<long>").repartition(3)
    assert {tuple(r) for r in jaccard.blocks(frame).collect()} == want
    assert jaccard.blocks(frame.where("false")).collect() == []


def test_texts_not_wanted_go_before_they_are_shuffled(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2}x{j}" for j in range(40)) + f" y{i}") for i in range(40)], "doc_id long, text string")
    described = jaccard.describe(docs, 75)
    sets = described.select("node", "n", "counts", "first")
    owners = described.select("node", "doc_id", "digest")
    node = {r.doc_id: r.node for r in owners.collect()}
    pairs = spark.createDataFrame([(node[0], node[1]), (node[1], node[2])], "a long, b long")
    found = jaccard.verified(pairs, sets, owners, docs, 75)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan)
    assert [tuple(r) for r in found.collect()] == [(node[0], node[1])]


def test_word_keys_part_the_same_words():
    words = ["a", "A", "b", "abcdefgh", "ABCDEFGH", "abcdefgi", "abcdefghi", "x" * 32, "x" * 33, "X" * 33, "x" * 40, "y" * 70, "@[`{", "é", "É", "a\x00"]
    data, offsets = common.utf8(pa.array([" ".join(words), "", None, "a"]))
    starts, ends, rows = common.word_borders(data, offsets)
    assert rows.tolist() == [0] * len(words) + [3]
    one, other = common.word_keys(data, starts, ends).tolist(), common.word_hashes(data, starts, ends).tolist()
    assert [one.index(x) for x in one] == [other.index(x) for x in other]
    assert len(set(one)) == len(set(words)) - 3
