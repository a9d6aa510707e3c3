"""URL filtering: host and path rules, and a character language-model ratio for the rest.

Two smoothed variable-order Markov models over the characters of a URL, one of accepted and one of
rejected URLs, give a length-normalised log-likelihood difference. The cut between accept and
reject is calibrated on URLs that the models have not seen; then these are counted as well. The
models are tables of exact counts by n-gram, which grow with the input and stay on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import spare_name, stored, utf8

#: Longest n-gram: a character and up to four before it.
ORDERS = 5
#: About so many rows are scored together; each n-gram in them is looked up once.
CHUNK = 4096
#: Weight of the shorter context in the estimate from a longer one.
SMOOTHING = 2.0
#: Scores are calibrated on a grid of this step.
STEP = 0.02
_PAD, _END = 256, 257
_BITS = 9  # of a code; the length of an n-gram stands above its codes
_LENGTH = _BITS * ORDERS


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, host/path) that fits: its text and its verdict, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def gram_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every character and the end of every text: the n-grams that end there, as numbers of their own.

    Returns (n-grams by length 1..ORDERS, their contexts by length 0..ORDERS-1, row numbers). A context
    has the number of the n-gram with the same characters.
    """
    data, offsets = utf8(column)
    n = len(column)
    sizes = np.diff(offsets)
    width = sizes + ORDERS  # ORDERS - 1 signs before, the end sign after
    begin = np.cumsum(width) - width
    codes = np.full(int(width.sum()), _PAD, np.int64)
    codes[np.arange(len(data)) - np.repeat(offsets[:-1] - begin, sizes) + ORDERS - 1] = data
    codes[begin + width - 1] = _END
    rows = np.repeat(np.arange(n), sizes + 1)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes + 1) - (sizes + 1), sizes + 1) + begin[rows] + ORDERS - 1
    context, grams, contexts = np.zeros(len(at), np.int64), [], [np.zeros(len(at), np.int64)]
    for order in range(1, ORDERS + 1):
        grams.append(order << _LENGTH | context << _BITS | codes[at])
        if order < ORDERS:
            context = context | codes[at - order] << _BITS * (order - 1)
            contexts.append(order << _LENGTH | context)
    return np.array(grams), np.array(contexts), rows


def train(labelled: DataFrame) -> DataFrame:
    """Counts of (url, label 0/1, held_out 0/1) rows: gram, and c<label><held_out> for each of the four.

    One row for each distinct n-gram of any length, no bytes of it merged with another. The empty n-gram
    counts the characters, and one of signs before the text alone the urls, so every context is found
    among the n-grams. All rows are counted, each batch for itself first. Null urls count as empty ones.
    """
    names = ["gram", "c00", "c01", "c10", "c11"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, contexts, rows = gram_keys(batch.column(0))
            kind = 2 * batch.column(1).to_numpy().astype(np.int64) + batch.column(2).to_numpy()
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            keys = np.concatenate((grams.ravel(), contexts[0], contexts[1:, first].ravel()))
            kinds = np.concatenate((np.tile(kind[rows], ORDERS + 1), np.tile(kind[rows[first]], ORDERS - 1)))
            found, at = np.unique(keys, return_inverse=True)
            counts = np.bincount(at * 4 + kinds, minlength=4 * len(found)).reshape(-1, 4)
            yield pa.record_batch([pa.array(found), *(pa.array(counts[:, i]) for i in range(4))], names=names)

    counted = labelled.mapInArrow(count, ", ".join(f"{name} long" for name in names))
    return counted.groupBy("gram").agg(*(F.sum(name).alias(name) for name in names[1:]))


def score(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """Append ``score`` to rows whose first column is the url: mean log ratio of label 1 to label 0.

    ``counts`` has gram, n0 and n1. Rows are dealt into chunks by hash; a chunk sends each of its
    n-grams once to the counts and gets back what is known of them. A frequent n-gram has a row a
    chunk, not one a url.
    """
    names = [*urls.columns, "score"]
    chunk = spare_name(urls, "_chunk")
    n_chunks = max(1, -(-urls.count() // CHUNK))
    dealt = urls.withColumn(chunk, F.pmod(F.xxhash64(*urls.columns), F.lit(n_chunks)))

    def wanted(own: pa.Table) -> pa.Table:
        grams, contexts, _ = gram_keys(own.column(0).combine_chunks())
        keys = np.unique(np.concatenate((grams, contexts), axis=None))
        return pa.table({chunk: pa.array(np.full(len(keys), own.column(1)[0].as_py())), "gram": pa.array(keys)})

    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        grams, contexts, rows = gram_keys(own.column(0).combine_chunks())
        keys = known.column("gram").to_numpy()
        order = np.argsort(keys)
        keys = np.append(keys[order], np.iinfo(np.int64).max)
        at, context_at = np.searchsorted(keys, grams), np.searchsorted(keys, contexts)
        hit, context_hit = keys[at] == grams, keys[context_at] == contexts
        total = np.zeros(len(rows))
        for name, sign in (("n1", 1.0), ("n0", -1.0)):
            n = np.append(known.column(name).to_numpy()[order], 0)
            chance = np.full(len(rows), 1 / 258)
            for i in range(ORDERS):
                seen = n[at[i]] * hit[i]
                base = n[context_at[i]] * context_hit[i]
                chance = (seen + SMOOTHING * chance) / (base + SMOOTHING)
            total += sign * np.log(chance)
        mean = np.bincount(rows, total, minlength=own.num_rows) / np.bincount(rows, minlength=own.num_rows)
        return own.drop_columns([chunk]).append_column("score", pa.array(mean)).select(names)

    asked = dealt.select(urls.columns[0], chunk).groupBy(chunk).applyInArrow(wanted, f"`{chunk}` long, gram long")
    known = asked.join(counts.select("gram", "n0", "n1"), "gram").select(chunk, "gram", "n0", "n1")
    fields = ", ".join(f"`{name}` {kind}" for name, kind in urls.dtypes)
    return dealt.groupBy(chunk).cogroup(known.groupBy(chunk)).applyInArrow(run, f"{fields}, score double")


def calibrate(scored: DataFrame) -> float:
    """The cut with the least mean error of both labels over (label, score) rows, on a grid of scores.

    With only one label the cut leaves all on that label's side; without rows all are accepted.
    """
    bin_ = F.greatest(F.lit(-1000), F.least(F.lit(1000), F.floor(F.col("score") / STEP))).cast("int")
    counts = np.zeros((2, 2001))
    for row in scored.groupBy("label", bin_.alias("bin")).count().collect():
        counts[row["label"], row["bin"] + 1000] = row["count"]
    sums = counts.sum(axis=1)
    if not sums.all():
        return np.inf if sums[0] else -np.inf
    below = np.concatenate((np.zeros((2, 1)), np.cumsum(counts, axis=1)), axis=1) / sums[:, None]
    error = below[1] + 1 - below[0]
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return (float(best[len(best) // 2]) - 1000) * STEP  # the middle of the gap between the labels


def filter_urls(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Judge (page_id, url): host, path, rule, verdict (allow or block) and score.

    The longest fitting rule decides. URLs with a rule also teach the models: every fifth by hash
    calibrates the cut of models taught by the others, then all of them are counted. The models decide
    the rest. A null or empty url has an empty host and path and is judged by the models. Rows are
    judged one by one, repeated ones alike.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = longest_rule(host, path, rules)
    judged = urls.select(
        "url", "page_id", host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("verdict")
    )
    label = (F.col("verdict") == "allow").cast("int")
    held_out = (F.pmod(F.xxhash64("url"), F.lit(5)) == 0).cast("int")
    known = judged.where("verdict IS NOT NULL").select("url", label.alias("label"), held_out.alias("held_out"))
    counts = stored(train(known), "url-grams")
    taught = counts.select("gram", F.col("c00").alias("n0"), F.col("c10").alias("n1")).where("n0 + n1 > 0")
    cut = calibrate(score(known.where("held_out = 1").select("url", "label"), taught))
    whole = counts.select("gram", F.expr("c00 + c01").alias("n0"), F.expr("c10 + c11").alias("n1"))
    chosen = F.when(F.col("score") >= F.lit(cut), F.lit("allow")).otherwise(F.lit("block"))
    return score(judged, whole).withColumn("verdict", F.coalesce("verdict", chosen))
