"""Named queries: every operator on the whole test tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlode.catalog import views
from claimlode.functions import text as tx
from claimlode.functions import vectors as vc
from claimlode.operators import audit, cells, encode, joins, numbering, search
from claimlode.plans import evaluate
from claimlode.plans import search as searches
from claimlode.session import shared_path, ship_package
from claimlode.sources import batch_files, tables
from claimlode.streaming.ingest import ingest_incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTER: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        ship_package(spark)
        return build(spark, root)

    REGISTER[build.__name__] = run
    return build


def _score(name: str = "score"):
    return vc.rounded(F.col(name)).alias(name)


def _unrolled(df: DataFrame, key: str, vector: str) -> DataFrame:
    """One row per value; a row without a vector stays, with nulls."""
    rows = df.select(key, F.posexplode_outer(vector).alias("dim", "value"))
    return rows.select(key, "dim", vc.rounded(F.col("value").cast("double")).alias("value"))


def _values(vector: str):
    """All values of a vector in order, as text with six decimals."""
    six = F.transform(vector, lambda x: F.call_function("format_number", x.cast("double"), F.lit("0.000000")))
    return F.array_join(six, ",").alias("vector_values")


# ---- sources and sinks ------------------------------------------------------------------------


@query
def read_claims(spark, root):
    return views.documents(spark, root)


@query
def page_claims(spark, root):
    rows = views.claims(spark, root)
    return numbering.page(rows, ["patent_id", "claim_no"], ["row_id"], offset=100, size=50)


@query
def page_deep(spark, root):
    rows = views.table(spark, root, "orders").select("o_orderkey", "o_custkey")
    return numbering.page(rows, ["o_orderkey"], ["o_orderkey"], offset=12_000, size=500)


@query
def page_indexed(spark, root):
    """Pages at three depths from one stored index; each reads the one or two ranges it lies in."""
    rows = views.table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    index = numbering.write_page_index(rows, ["o_custkey", "o_orderkey"], ["o_orderkey"], shared_path(spark, "page-index"))
    pages = [
        numbering.read_page(spark, index, offset, 50).withColumn("page", F.lit(page))
        for page, offset in enumerate((0, index.rows // 2, index.rows - 20))
    ]
    return audit.union_batches(*pages)


@query
def assign_batches(spark, root):
    rows = views.table(spark, root, "documents").select("doc_id", "source")
    return numbering.assign_batches(rows, ["source", "doc_id"], ["doc_id"], size=64)


@query
def assign_batches_resume(spark, root):
    rows = views.table(spark, root, "documents").select("doc_id", "source")
    return numbering.assign_batches(
        rows, ["source", "doc_id"], ["doc_id"], size=64, start_offset=128, first_batch=3
    )


@query
def csv_round_trip(spark, root):
    path = shared_path(spark, "claims-csv")
    columns = ["patent_id", "cleaned_claim"]
    tables.write_result_csv(views.cleaned_claims(spark, root).select(*columns), path)
    return tables.read_metadata_csv(spark, path, columns)


@query
def write_batches(spark, root):
    path = shared_path(spark, "batches")
    batch_files.write_batches(views.metadata_batches(spark, root), path)
    return spark.read.parquet(path).select("batch_id", "pos", "patent_id", "cleaned_claim")


@query
def append_vectors(spark, root):
    path = shared_path(spark, "vector-table")
    tables.append_vectors(zip_batches(spark, root), path, views.DIM)
    return spark.read.parquet(path).select("patent_id", "cleaned_claim", _values("embedding"))


@query
def vector_table(spark, root):
    """The named (id, text, vector) table: made once, appended to twice, dropped after it was read into a file."""
    name, path = f"vectors_{uuid.uuid4().hex[:12]}", shared_path(spark, "named-vectors")
    rows = zip_batches(spark, root)
    for part in (rows.where("batch_id % 2 = 0"), rows.where("batch_id % 2 = 1")):
        tables.create_vector_table(spark, name, path)
        tables.append_vectors(part, name, views.DIM)
    kept = views.stored(spark.table(name), "named-rows")
    spark.sql(f"DROP TABLE {name}")
    return kept.select("patent_id", "cleaned_claim", _values("embedding"))


def _imported(spark, root):
    """Text and vector batches written as files of the older layout and read back, vectors in slices of 4 KB."""
    path = shared_path(spark, "batch-files")
    batch_files.write_batch_files(views.metadata_batches(spark, root), views.vector_batches(spark, root), path)
    return batch_files.read_metadata_batches(spark, path), batch_files.read_vector_batches(spark, path, slice_bytes=4096)


@query
def import_vector_files(spark, root):
    return _imported(spark, root)[1].select("batch_id", "pos", _values("embedding"))


@query
def import_batch_files(spark, root):
    """Pair, check and zip the imported files."""
    meta, vectors = _imported(spark, root)
    return audit.zip_rows(meta, vectors).select("batch_id", "pos", "patent_id", "cleaned_claim", _values("embedding"))


@query
def load_batches(spark, root):
    """What became of each batch of a load; the vectors of batch 3 have a wrong dimension."""
    path = shared_path(spark, "loaded")
    meta, vectors = _batches_with_a_bad_one(spark, root)
    return audit.load_batches(meta, vectors, lambda rows: tables.append_vectors(rows, path, views.DIM), group=4)


def _batches_with_a_bad_one(spark, root):
    cut = F.when(F.col("batch_id") == 3, F.slice("embedding", 1, views.DIM - 1)).otherwise(F.col("embedding"))
    return views.metadata_batches(spark, root), views.vector_batches(spark, root).withColumn("embedding", cut)


@query
def load_audit_real(spark, root):
    """Three loads into one table: whole batches only; with skipped and failing ones; with rows of another writer."""
    path = shared_path(spark, "loaded")
    meta, vectors = _batches_with_a_bad_one(spark, root)
    empty = spark.createDataFrame([], "patent_id string, cleaned_claim string, embedding array<float>")
    empty.write.parquet(path)

    def rows_now() -> int:
        return audit.row_count(spark.read.schema(empty.schema).parquet(path)).first()[0]

    def load(some, stranger=None):
        before = rows_now()
        manifest = audit.load_batches(
            meta.where(some), vectors.where(some), lambda rows: tables.append_vectors(rows, path, views.DIM), group=4
        )
        if stranger is not None:
            tables.append_vectors(stranger, path, views.DIM)
        return audit.load_audit(manifest, before, rows_now())

    loads = [
        load(F.col("batch_id") < 2),
        load(F.col("batch_id") >= 2),
        load(F.col("batch_id") == 1, zip_batches(spark, root).where("batch_id = 0")),
    ]
    return audit.union_batches(*(told.withColumn("load", F.lit(i)) for i, told in enumerate(loads)))


def zip_batches(spark, root):
    return audit.zip_rows(views.metadata_batches(spark, root), views.vector_batches(spark, root))


@query
def pair_batches(spark, root):
    return audit.pair_batches(views.metadata_batches(spark, root), views.vector_batches(spark, root))


@query
def zip_rows_checked(spark, root):
    return zip_batches(spark, root).select("batch_id", "pos", "patent_id", "cleaned_claim", _values("embedding"))


def _manifest(spark, root):
    return audit.load_manifest(
        views.metadata_batches(spark, root),
        views.vector_batches(spark, root),
        zip_batches(spark, root),
    )


@query
def load_audit(spark, root):
    manifest = _manifest(spark, root)
    return audit.load_audit(manifest, 0, audit.row_count(zip_batches(spark, root)))


@query
def audit_totals(spark, root):
    return audit.audit_totals(_manifest(spark, root))


@query
def row_count(spark, root):
    return audit.row_count(views.documents(spark, root))


@query
def rows_per_batch(spark, root):
    return audit.rows_per_batch(views.metadata_batches(spark, root))


@query
def distinct_ids(spark, root):
    rows = views.claims(spark, root)
    return rows.agg(joins.distinct_count(rows, "patent_id").alias("ids"))


@query
def union_batches(spark, root):
    return audit.union_batches(
        views.documents(spark, root).select(F.col("doc_id").alias("row_id"), "text"),
        views.table(spark, root, "benchmark").select(F.col("item_id").alias("row_id"), "text"),
        views.table(spark, root, "pages").select(
            F.col("page_id").alias("row_id"), F.col("html").alias("text")
        ),
    )


@query
def ingest_runs(spark, root):
    """The incremental job over three arrivals and three runs: one stops in its second micro-batch, one repeats
    that batch and goes on, one takes the arrival that came later. Every row once. An arrival has as many files as
    its table has splits, so no task holds it whole, and a micro-batch takes the files of about one arrival."""
    source, target, checkpoint = (shared_path(spark, name) for name in ("arrivals", "ingested", "ingest-state"))
    docs = views.table(spark, root, "documents")

    def arrive(part: int) -> None:
        docs.where(F.col("doc_id") % 3 == part).write.mode("append").parquet(source)

    def run(encoder) -> None:
        ingest_incremental(
            spark,
            source,
            target,
            checkpoint,
            docs.schema,
            encoder,
            prepare=views.as_claims,
            files_per_trigger=first_files,
            spread_by="row_id",
        )

    batches = []

    def fails_second(claims, text):
        batches.append(text)
        if len(batches) == 2:
            raise RuntimeError("the encoder is gone")
        return views.encode(claims, text)

    arrive(0)
    first_files = len(spark.read.parquet(source).inputFiles())
    arrive(1)
    try:
        run(fails_second)
    except StreamingQueryException:
        run(views.encode)
    arrive(2)
    run(views.encode)
    done = spark.read.parquet(target)
    return done.select("row_id", "patent_id", "claim_text", "cleaned_claim", _values("embedding"))


REGISTER["ingest_incremental"] = REGISTER.pop("ingest_runs")


# ---- projections and predicates ---------------------------------------------------------------


@query
def clean_claim(spark, root):
    pages = views.table(spark, root, "pages")
    return pages.select("page_id", tx.clean_claim(F.col("html")).alias("cleaned"))


@query
def clean_claim_docs(spark, root):
    return views.cleaned_claims(spark, root).select("row_id", "cleaned_claim")


@query
def blank_filter(spark, root):
    claims = views.claims(spark, root)
    return claims.select("row_id", tx.is_blank(F.col("claim_text")).alias("blank"))


@query
def drop_blank(spark, root):
    return views.documents(spark, root).where(~tx.is_blank(F.col("text"))).select("doc_id")


@query
def id_string(spark, root):
    return views.numbers(spark, root).select(
        "item",
        tx.id_string(F.col("item")).alias("id"),
        tx.id_string(F.col("publication_number")).alias("number"),
    )


def _number_rule(name, rule):
    def build(spark, root):
        number = F.col("publication_number")
        alias = {"publication_digits": "digits", "publication_core": "core"}.get(name, "norm_id")
        return views.numbers(spark, root).select("item", rule(number).alias(alias))

    build.__name__ = name
    return query(build)


for _name in ("publication_digits", "publication_core", "normalize_id"):
    _number_rule(_name, getattr(tx, _name))


@query
def filter_ids(spark, root):
    labels = views.table(spark, root, "labels")
    patent = F.expr("string(1000000 + doc_id div 4)").alias("patent_id")
    good = labels.where("quality = 1").select(patent)
    bad = labels.where("toxic = 1").select(patent)
    kept = joins.filter_ids(views.claims(spark, root), good, bad, "patent_id")
    return kept.select("row_id", "patent_id", "claim_text", "in_a", "in_b")


@query
def l2_normalize(spark, root):
    tripled = F.transform("embedding", lambda x: x * F.lit(3.0).cast("float"))
    rows = views.corpus(spark, root).select("row_id", vc.l2_normalize(tripled).alias("unit"))
    return _unrolled(rows, "row_id", "unit")


@query
def vector_dim(spark, root):
    return views.corpus(spark, root).select("row_id", vc.vector_dim(F.col("embedding")).alias("dim"))


def _vector_pairs(spark, root):
    """Each vector beside the one at half its number."""
    left = views.corpus(spark, root).select("row_id", F.col("embedding").alias("a"))
    right = views.corpus(spark, root).select(
        F.col("row_id").alias("half"), F.col("embedding").alias("b")
    )
    return left.withColumn("half", F.expr("row_id div 2")).join(right, "half")


def _pair_rule(name, rule):
    def build(spark, root):
        value = vc.rounded(rule(F.col("a"), F.col("b"))).alias("value")
        return _vector_pairs(spark, root).select("row_id", value)

    build.__name__ = name
    return query(build)


for _name in ("inner_product", "l2_sq", "cosine"):
    _pair_rule(_name, getattr(vc, _name))


@query
def fmt4(spark, root):
    price = tx.fmt4(F.col("l_extendedprice") / 7).alias("price")
    return views.table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", price)


@query
def parse_vector(spark, root):
    text = vc.format_vector(F.col("embedding"))
    back = views.corpus(spark, root).select("row_id", vc.parse_vector(text).alias("v"))
    return back.select("row_id", F.size("v").alias("dim"), _values("v"))


@query
def project_columns(spark, root):
    rows = views.claims(spark, root).select(F.col("claim_text").alias("claim"), "patent_id")
    return tx.add_null_columns(rows, ["top_patents", "found_itself"])


@query
def drop_nulls(spark, root):
    return joins.drop_nulls(views.external(spark, root), "publication_number")


# ---- joins and sets ---------------------------------------------------------------------------


@query
def values_table(spark, root):
    """A literal list of ids, as a check table is, met with the claims."""
    ids = [("1000000", "first"), ("1000007", "kept"), ("1000049", "kept"), ("42", "unknown"), (None, "none")]
    listed = tables.values_table(spark, ids, "patent_id string, note string")
    claims = views.claims(spark, root).select("row_id", "patent_id")
    return joins.left_join_1n(listed, claims, "patent_id").select("patent_id", "note", "row_id")


@query
def left_join_1n(spark, root):
    listed, claims = views.listed_patents(spark, root), views.claim_table(spark, root)
    return joins.left_join_1n(listed, claims, "patent_id")


def _sides(spark, root):
    """The claims of even and of odd sources."""
    claims = views.claims(spark, root, "source")
    even = F.substring("source", 4, 10).cast("int") % 2 == 0
    return claims.where(even).drop("source"), claims.where(~even).drop("source")


@query
def exact_text_match(spark, root):
    return joins.exact_text_match(*_sides(spark, root), "patent_id", "claim_text")


@query
def match_groups(spark, root):
    return joins.match_groups(*_sides(spark, root), "patent_id", "claim_text")


@query
def keep_in_list(spark, root):
    claims = views.claims(spark, root).select("row_id", "patent_id", "claim_text")
    kept = joins.keep_in_list(claims, views.listed_patents(spark, root), "patent_id")
    return kept.select("row_id", "patent_id", "claim_text")


@query
def missing_ids(spark, root):
    return joins.missing_ids(views.listed_patents(spark, root), views.claims(spark, root), "patent_id")


@query
def id_difference(spark, root):
    return joins.id_difference(views.listed_patents(spark, root), views.corpus(spark, root), "patent_id")


@query
def id_intersection(spark, root):
    listed, corpus = views.listed_patents(spark, root), views.corpus(spark, root)
    return joins.id_intersection(listed, corpus, "patent_id")


@query
def list_coverage(spark, root):
    return evaluate.list_coverage(views.listed_patents(spark, root), views.corpus(spark, root))


@query
def attach_external(spark, root):
    rows = views.queries(spark, root).select("query_id", "patent_id")
    return joins.attach_external(rows, evaluate.external_lists(views.external(spark, root)))


# ---- first occurrences and packed lists -------------------------------------------------------


@query
def first_n_unique(spark, root):
    numbered = views.external(spark, root).withColumn(
        "number", tx.publication_digits(F.col("publication_number"))
    )
    return evaluate.first_n_unique(numbered, "query_id", "number", "pos")


@query
def pack_lists(spark, root):
    lists = evaluate.external_lists(views.external(spark, root))
    items = F.size(tx.unpack_list(F.col("external_patents"))).alias("items")
    return lists.select("query_id", "external_patents", items)


@query
def first_occurrence(spark, root):
    rows = views.external(spark, root).where(F.col("publication_number").isNotNull())
    return search.first_occurrence(rows, "query_id", "publication_number", ("pos",))


@query
def overlap_count(spark, root):
    known = views.corpus(spark, root).select(F.col("label").cast("bigint").alias("query_id"), F.col("patent_id").alias("number"))
    listed = views.external(spark, root).withColumn("number", tx.publication_digits(F.col("publication_number")))
    first = evaluate.first_n_unique(listed, "query_id", "number", "pos")
    return joins.overlap_counts(known, first, "query_id", "number")


# ---- search -----------------------------------------------------------------------------------


def _hits(df):
    return df.select("query_id", "rank", "row_id", _score())


@query
def topk_inner(spark, root):
    return _hits(search.topk_inner(views.queries(spark, root), views.corpus(spark, root), 10))


@query
def topk_l2(spark, root):
    return _hits(search.topk_l2(views.queries(spark, root), views.corpus(spark, root), 5))


@query
def attach_metadata(spark, root):
    asked = views.queries(spark, root)
    hits = search.topk_inner(asked, views.corpus(spark, root), 10)
    claims = views.claim_table(spark, root)
    found = joins.attach_metadata(hits, claims, hit_rows=asked.count() * 10)
    return found.select("query_id", "rank", "row_id", "patent_id", "cleaned_claim")


@query
def topk_distinct(spark, root):
    hits = search.topk_distinct(views.queries(spark, root), views.corpus(spark, root))
    return hits.select("query_id", "rank", "row_id", "patent_id", _score())


def _by_label(spark, root, overfetch):
    hits = search.topk_distinct(
        views.queries(spark, root), views.corpus(spark, root), "label", 5, overfetch
    )
    return hits.select("query_id", "rank", "row_id", "label", _score())


@query
def topk_distinct_short(spark, root):
    return _by_label(spark, root, 5)


@query
def topk_distinct_exact(spark, root):
    return _by_label(spark, root, None)


def _first_of_list(spark, root):
    rows = views.listed_patents(spark, root).join(views.corpus(spark, root), "patent_id")
    place = F.struct("pos", "row_id").alias("place")
    return search.pick_query(rows.select(place, "patent_id", "embedding"), "place", "patent_id")


@query
def pick_query(spark, root):
    return _first_of_list(spark, root).select("place.*", "patent_id")


def _ranked(spark, root):
    return search.rank_all(_first_of_list(spark, root), views.corpus(spark, root))


@query
def rank_all(spark, root):
    return _ranked(spark, root).select("row_id", "patent_id", _score())


@query
def sort_desc(spark, root):
    rows = _ranked(spark, root).select("row_id", _score())
    return numbering.sort_desc(rows, "score", "row_id", numbered=True)


@query
def head(spark, root):
    return numbering.head(_ranked(spark, root).select("row_id", _score()), "score", "row_id", 10)


@query
def compare_metrics(spark, root):
    asked, corpus = views.queries(spark, root), views.corpus(spark, root)
    near = search.topk_inner(asked, corpus, 10, carry=("patent_id",))
    return searches.compare_metrics(near, search.topk_l2(asked, corpus, 10, carry=("patent_id",)))


@query
def search_text(spark, root):
    asked = views.table(spark, root, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    claims = views.stored(views.encoded_claims(spark, root), "claims")
    found = searches.search_text(asked, claims, views.encode)
    return found.withColumn("score", vc.rounded(F.col("score")))


@query
def stamped_result(spark, root):
    """A search result written under the time of the run, and read back."""
    asked = views.queries(spark, root).where("query_id % 10 = 0")
    hits = search.topk_inner(asked, views.corpus(spark, root), 5, carry=("patent_id",))
    shown = hits.select("query_id", "rank", "row_id", "patent_id", _score())
    path = searches.write_stamped(shown, shared_path(spark, "results"))
    assert re.search(r"/query_results_\d{8}_\d{6}\.csv$", path)
    back = tables.read_metadata_csv(spark, path, shown.columns)
    return back.select(*(F.col(name).cast(kind).alias(name) for name, kind in shown.dtypes))


# ---- cells ------------------------------------------------------------------------------------


@query
def train_cells(spark, root):
    trained = cells.train_cells(views.corpus(spark, root), nlist=16, iterations=10)
    return trained.select("cell", F.size("centroid").alias("dim"))


def _trained_search(spark, root, metric, k):
    """Train on the first batches, assign and write every row, search all cells: equal to the exact search."""
    rows = views.corpus(spark, root)
    sample = numbering.assign_batches(rows, ["row_id"], ["row_id"], size=50).where("batch_id < 4")
    centroids = cells.train_cells(sample, nlist=8, metric=metric, iterations=10)
    path = shared_path(spark, "trained-cells")
    cells.write_cells(cells.assign_cells(rows, centroids, metric), path)
    stored = spark.read.parquet(path)
    return _hits(cells.search_cells(views.queries(spark, root), stored, centroids, k, 8, metric))


@query
def search_trained_cells_all(spark, root):
    return _trained_search(spark, root, vc.INNER, 10)


@query
def search_trained_cells_all_l2(spark, root):
    return _trained_search(spark, root, vc.L2, 5)


# A claim's columns in the cells, and all that the retrieval checks read of the searched claims.
INDEXED = ("row_id", "patent_id", "embedding")


def _text_index(spark, root, *columns):
    """Claims encoded and stored, with ``columns`` if given, and all cells of an index trained on the first of them.

    The cells hold what a search reads of a claim; its text stays in the table of claims.
    """
    coded = views.encoded_claims(spark, root)
    claims = views.stored(coded.select(*columns) if columns else coded, "claims")
    indexed = claims.select(*INDEXED)
    path = shared_path(spark, "claim-cells")
    return claims, cells.build_index(indexed, indexed.where("row_id < 400"), path, nlist=6, nprobe=6, iterations=8)


@query
def search_text_cells(spark, root):
    """Text queries over stored cells, all probed: equal to the exact search."""
    asked = views.table(spark, root, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    claims, index = _text_index(spark, root)
    found = searches.search_text(asked, claims, views.encode, index=index)
    return found.withColumn("score", vc.rounded(F.col("score")))


@query
def self_retrieval_cells(spark, root):
    """From claim text to the found-itself flag over stored cells, all probed: equal to the exact check."""
    claims, index = _text_index(spark, root, *INDEXED)
    check = views.stored(views.check_table(spark, root), "check")
    return evaluate.self_retrieval(check, claims, index=index)


@query
def external_overlap_cells(spark, root):
    claims, index = _text_index(spark, root, *INDEXED)
    check = views.stored(views.check_table(spark, root), "check")
    log = evaluate.similarity_log(check, claims, index=index)
    return evaluate.external_overlap(log, views.external(spark, root)).drop("claim", "similarities")


@query
def search_cells_recall(spark, root):
    """Share of the exact 10 best rows that 1, 3 and all 10 cells give; over all vectors as queries."""
    asked, corpus = views.queries(spark, root), views.corpus(spark, root)
    stored, centroids = _stored_cells(spark, root), views.label_centroids(spark, root)
    exact = views.stored(search.topk_inner(asked, corpus, 10).select("query_id", "row_id"), "exact")
    parts = []
    for nprobe in (1, 3, 10):
        near = cells.search_cells(asked, stored, centroids, 10, nprobe).select("query_id", "row_id", F.lit(1).alias("hit"))
        both = exact.join(near, ["query_id", "row_id"], "left")
        parts.append(both.agg(F.lit(nprobe).alias("nprobe"), F.count("*").alias("wanted"), F.count("hit").alias("found")))
    recall = F.round(F.col("found") / F.col("wanted"), 6).alias("recall")
    return audit.union_batches(*parts).select("nprobe", "wanted", "found", recall)


@query
def search_cells_until(spark, root):
    """Eight different labels per query: one cell first, more while a query is short of labels."""
    hits = cells.search_cells_until(
        views.queries(spark, root), _mixed_cells(spark, root), views.label_centroids(spark, root), "label", 8
    )
    return hits.select("query_id", "rank", "row_id", "label", _score(), "probed")


def _mixed_cells(spark, root):
    path = shared_path(spark, "cells")
    cells.write_cells(cells.assign_cells(views.corpus(spark, root), views.label_centroids(spark, root)), path)
    return spark.read.parquet(path)


@query
def assign_cells_tree(spark, root):
    """Cells of cells against the flat assignment: every eighth vector is a cell."""
    rows = views.corpus(spark, root)
    centroids = rows.where("row_id % 8 = 0").select(F.col("row_id").cast("int").alias("cell"), F.col("embedding").alias("centroid"))
    tree = cells.cell_tree(centroids, rows)
    flat = cells.assign_cells(rows, centroids).select("row_id", F.col("cell").alias("flat"))
    quick = cells.assign_cells_by_tree(rows, tree).select("row_id", F.col("cell").alias("quick"))
    whole = cells.assign_cells_by_tree(rows, tree, looks=len(tree.coarse)).select("row_id", F.col("cell").alias("whole"))
    both = flat.join(quick, "row_id").join(whole, "row_id")
    return both.agg(
        F.count("*").alias("rows"),
        (F.avg((F.col("flat") == F.col("quick")).cast("int")) >= 0.99).alias("agreed"),
        F.count_if(F.col("flat") == F.col("whole")).alias("same_whole"),
        F.sum("flat").alias("cells"),
    )


@query
def cell_centroids(spark, root):
    rows = views.label_centroids(spark, root)
    return _unrolled(rows, "cell", "centroid")


def _celled(spark, root):
    return cells.assign_cells(views.corpus(spark, root), views.label_centroids(spark, root))


def _stored_cells(spark, root):
    path = shared_path(spark, "cells")
    cells.write_cells(_celled(spark, root), path)
    return spark.read.parquet(path)


@query
def assign_cells(spark, root):
    return _celled(spark, root).select("row_id", "patent_id", "cell")


@query
def write_cells(spark, root):
    return _stored_cells(spark, root).select("row_id", "patent_id", "cell")


@query
def probe_join(spark, root):
    probes = cells.nearest_cells(
        _first_of_list(spark, root), views.label_centroids(spark, root), 3, vc.INNER
    ).select(F.explode("cells").alias("cell"))
    kept = cells.probe_join(probes, _stored_cells(spark, root))
    return kept.select("row_id", "patent_id", "cell")


def _cell_search(spark, root, nprobe):
    """Search over the stored cell layout."""
    stored, centroids = _stored_cells(spark, root), views.label_centroids(spark, root)
    return _hits(cells.search_cells(views.queries(spark, root), stored, centroids, 10, nprobe))


@query
def search_cells(spark, root):
    return _cell_search(spark, root, 1)


@query
def search_cells_nprobe(spark, root):
    return _cell_search(spark, root, 3)


@query
def search_cells_all(spark, root):
    """All cells probed: equal to the exact search."""
    return _cell_search(spark, root, 10)


# ---- encoding ---------------------------------------------------------------------------------


@query
def hash_encode(spark, root):
    return _unrolled(views.encoded_claims(spark, root), "row_id", "embedding")


def _plugged(spark, root, **options):
    rows = views.cleaned_claims(spark, root).select("row_id", "cleaned_claim")
    factory = encode.WordHashEncoder(views.DIM)
    coded = encode.encode_text(rows, "cleaned_claim", factory, pieces=8, **options)
    # A text without words has the zero vector, which has no direction.
    found = F.when(F.exists("embedding", lambda x: x != 0), F.col("embedding"))
    return _unrolled(coded.withColumn("embedding", found), "row_id", "embedding")


@query
def encode_text(spark, root):
    return _plugged(spark, root)


@query
def encode_once(spark, root):
    return _plugged(spark, root, once_per_text=True)


# ---- evaluation -------------------------------------------------------------------------------


def _retrieval_tables(spark, root):
    """Embed first, then search the stored vectors."""
    return (
        views.stored(views.check_table(spark, root), "check"),
        views.stored(views.encoded_claims(spark, root), "claims"),
    )


def _checked(spark, root):
    return evaluate.similarity_log(*_retrieval_tables(spark, root))


@query
def self_retrieval(spark, root):
    return evaluate.self_retrieval(*_retrieval_tables(spark, root))


@query
def similarity_log(spark, root):
    return _checked(spark, root)


@query
def external_overlap(spark, root):
    done = evaluate.external_overlap(_checked(spark, root), views.external(spark, root))
    return done.drop("claim", "similarities")


@query
def one_vs_list_ranked(spark, root):
    scored = evaluate.one_vs_list_ranked(
        _first_of_list(spark, root), views.corpus(spark, root), views.listed_patents(spark, root)
    )
    return scored.select("row_id", "patent_id", "norm_id", _score("similarity"))


@query
def one_vs_list_direct(spark, root):
    claims = views.claim_table(spark, root)
    scored = evaluate.one_vs_list_direct(views.listed_patents(spark, root), claims, views.encode)
    return scored.select("pos", "row_id", "patent_id", "cleaned_claim", _score("similarity_to_first"))
