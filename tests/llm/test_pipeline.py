"""The stages of the corpus pipeline against plain versions of them."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimlode.llm import mixing, packing, quality, repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc_id__ long, source__ string, label int, doc long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "doc_id__", "source__", "label", "doc"]
WORDS = [f"w{i}" for i in range(900)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def table(spark, texts, sources=("a", "b", None)):
    rows = [(i, t, "en", sources[i % len(sources)], len(t or ""), 1, "s", 2, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def plain_passages(texts, words):
    """Each text without the runs of at least ``words`` words whose windows occur more than once."""
    seen = Counter()
    for t in texts:
        w = split(t)
        seen.update(tuple(w[i : i + words]) for i in range(len(w) - words + 1))
    for t in texts:
        if t is None:
            yield None
            continue
        places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        w = [t[a:b] for a, b in places]
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - words + 1):
            if seen[tuple(w[i : i + words])] > 1:
                gone[i : i + words] = True
        out, i, last = [], 0, 0
        while i < len(w):
            if gone[i]:
                j = i
                while j + 1 < len(w) and gone[j + 1]:
                    j += 1
                out.append(t[last : places[i][0]])
                last, i = places[j][1], j
            i += 1
        yield "".join(out) + t[last:]


def passage_texts(seed=1):
    rng = random.Random(seed)
    fresh = lambda n: " ".join(rng.choices(WORDS, k=n))
    short, exact, long = fresh(50), fresh(51), fresh(140)
    texts = [fresh(rng.choice([3, 60, 200])) for _ in range(30)]
    texts += [f"{fresh(20)} {short} {fresh(30)}" for _ in range(3)]  # 50 words: stays
    texts += [f"{fresh(20)}\n{exact}\t{fresh(30)}" for _ in range(3)]  # 51 words: goes
    texts += [f"{fresh(5)} {exact.replace(' ', '  ')}", exact, f"{exact} ü {exact}", exact.upper()]
    texts += [f"{fresh(9)} {long} {fresh(7)}", f"{fresh(4)}\n\n{long}", long[:200] + " " + fresh(40)]
    texts += ["ä ö " * 60, "", None, " \n ", "one", texts[0], texts[0], fresh(25_000)]
    return texts


@pytest.mark.parametrize(("words", "gram", "hot"), [(51, 64, 20_000), (51, 64, 1), (6, 16, 20_000)])
def test_passages_of_over_fifty_words(spark, words, gram, hot):
    texts = passage_texts()
    out = repeats.without_passages(table(spark, texts), words, gram, hot)
    assert out.columns == COLUMNS
    got = {r.doc_id: r for r in out.collect()}
    for i, want in enumerate(plain_passages(texts, words)):
        assert got[i].text == want, i
        assert got[i].n_chars == (None if want is None else len(want))


def test_a_text_longer_than_a_slice(spark):
    rng = random.Random(4)
    shared = " ".join(rng.choices(WORDS, k=80))
    big = " ".join(rng.choices(WORDS, k=700_000))
    assert len(big) > repeats._SLICE
    texts = [big[: len(big) // 2] + f" {shared} " + big[len(big) // 2 :], f"x {shared} y", "clean text"]
    got = {r.doc_id: r.text for r in repeats.without_passages(table(spark, texts)).collect()}
    assert shared not in got[0] and len(got[0]) == len(texts[0]) - len(shared)
    assert got[1] == "x  y" and got[2] == "clean text"


def test_extra_columns_with_inner_names(spark):
    docs = table(spark, [f"{w} text" for w in WORDS[:20]] + [None, ""])
    assert repeats.without_repeats(docs, 60, 16).columns == COLUMNS
    assert repeats.removal_report(docs, 60, 16).count() == 22
    assert mixing.mixed_documents(docs).columns == COLUMNS
    assert mixing.mix(docs).count() == 22


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(240):
        lines = [" ".join(rng.choices(WORDS, k=12)) + ("." if i % 4 else " %%% ###") for _ in range(rng.randint(1, 9))]
        texts.append("\n".join(lines))
        labels.append((i, int(i % 4 != 0), 0))
    shared = " ".join(rng.choices(WORDS, k=60))
    for i in (5, 17, 33, 61):
        texts[i] = "\n".join(" ".join(rng.choices(WORDS, k=40)) + "." for _ in range(3)) + "\n" + shared + ".\nEnd."
    texts += [texts[9], texts[9], texts[10] + " more", None, "", "ab"]
    root = str(tmp_path_factory.mktemp("corpus"))
    table(spark, texts).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_every_stage_against_a_plain_version(spark, corpus):
    before = spark.read.parquet(f"{corpus}/documents.parquet")
    labels = spark.read.parquet(f"{corpus}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = stage(spark, before, corpus)
        if name != "best_fit_packing":
            assert kept[name].columns == before.columns
        rows, out = before.collect(), kept[name].collect()
        if name == "quality_chain":
            good = {r.doc_id for r in quality.score_documents(before, labels).collect() if r.score >= 0.5}
            assert sorted(out) == sorted(r for r in rows if r.doc_id in good)
            assert not {r.doc_id for r in out} & set(range(0, 240, 4))
        if name == "jaccard_join":
            sets = {r.doc_id: shingles(r.text) for r in rows}
            low = {i: min(plain_component(i, sets)) for i in sets}
            assert sorted(r.doc_id for r in out) == sorted(i for i in sets if low[i] == i)
        if name == "suffix_dedup":
            want = dict(zip((r.doc_id for r in rows), plain_passages([r.text for r in rows], 51), strict=True))
            assert {r.doc_id: r.text for r in out} == want
            assert len({r.doc_id for r in rows if r.text != want[r.doc_id]}) == 4
        if name == "source_mixing":
            taken = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            assert Counter(r.doc_id for r in out) == Counter({i: n for i, n in taken.items() if n})
            check_shares(rows, taken)
        if name == "best_fit_packing":
            check_packing(rows, out)
        before = spark.createDataFrame(out, kept[name].schema)
    assert corpus_pipeline.run(spark, corpus).columns == kept["best_fit_packing"].columns


def shingles(text):
    words = [w.lower() for w in split(text)]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_component(i, sets):
    seen, todo = {i}, [i]
    while todo:
        a = todo.pop()
        near = {b for b in sets if b not in seen and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
        seen |= near
        todo += near
    return seen


def check_shares(rows, taken):
    sizes, words = defaultdict(int), defaultdict(int)
    largest = max(len(split(r.text)) for r in rows)
    for r in rows:
        sizes[r.source] += len(split(r.text))
        words[r.source] += taken[r.doc_id] * len(split(r.text))
        assert taken[r.doc_id] <= 3
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.targets([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))])
    for name, share in zip(names, want, strict=True):
        assert abs(words[name] - share) <= 3 * largest, name


def check_packing(rows, out):
    encode = packing.byte_bpe()
    assert sum(r.length for r in out) == sum(len(encode(r.text or "")) + 1 for r in rows)
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(r.doc_id for r in rows)
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for each in places.values():
        at = 0
        for offset, length in sorted(each):
            assert offset == at
            at += length
        assert at <= 2048


def test_an_empty_corpus(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).where(F.col("length") > 0).collect() == []


def test_the_mix_shuffles_whole_rows_once(spark, tmp_path):
    """Targets come by broadcast, and the totals join on the columns of the windows; null and '' are two sources."""
    path = str(tmp_path / "docs")
    rows = [(i, "w " * (i % 7), [None, "", "a"][i % 3]) for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(path)
    docs = spark.read.schema("doc_id long, text string, source string").parquet(path)
    mixed = mixing.mixed_documents(docs)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("SortMergeJoin") :] if "SortMergeJoin" in plan else plan
    whole = [line for line in left.splitlines() if "Exchange hashpartitioning(" in line and line.lstrip(" ").startswith(":")]
    assert plan.count("SortMergeJoin") <= 1 and len(whole) <= 1
    taken = {(r.doc_id, r.copies) for r in mixing.mix(docs).collect() if r.copies}
    assert {(r.doc_id, r["count"]) for r in mixed.groupBy("doc_id").count().collect()} == taken
    sources = {r.source: (r.source_size, r.target) for r in mixing.mix(docs).collect()}
    assert set(sources) == {None, "", "a"} and all(sources[s][0] for s in sources)
