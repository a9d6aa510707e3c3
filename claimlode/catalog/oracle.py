"""The registered queries once more as SQL for a second engine."""

from __future__ import annotations

SPACE = (
    r"[\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def clean(text: str) -> str:
    untagged = f"regexp_replace(coalesce({text}, ''), '<[^\\n]*?>', '', 'g')"
    return strip(f"regexp_replace({untagged}, 'the present invention[^\\n]*?\\.', '', 'gi')")


CLAIMS = """
claims AS (
  SELECT doc_id AS row_id, CAST(1000000 + doc_id // 4 AS VARCHAR) AS patent_id,
         CAST(doc_id % 4 AS INTEGER) AS claim_no,
         CASE WHEN doc_id % 97 <> 0 THEN
           concat(CASE WHEN doc_id % 3 = 0 THEN '<b>1.</b> ' ELSE '' END,
                  CASE WHEN doc_id % 5 = 0 THEN ' The Present Invention is shown. ' ELSE '' END,
                  text) END AS claim_text
  FROM documents)"""
CLEANED = f"""{CLAIMS},
cleaned AS (
  SELECT row_id, patent_id, claim_no, claim_text, {clean("claim_text")} AS cleaned_claim
  FROM claims)"""
CORPUS = """
corpus AS MATERIALIZED (
  SELECT vec_id AS row_id, CAST(1000000 + vec_id // 5 AS VARCHAR) AS patent_id, label,
         embedding::DOUBLE[] AS v
  FROM embeddings)"""
EXTERNAL = """
external AS (
  SELECT l_suppkey::BIGINT AS query_id, (l_orderkey * 8 + l_linenumber)::BIGINT AS pos,
         CASE WHEN l_returnflag <> 'R'
              THEN concat('US', CAST(1000000 + l_partkey // 4 AS VARCHAR), 'B2') END
           AS publication_number
  FROM lineitem)"""
LISTED = f"""{EXTERNAL},
listed AS (
  SELECT regexp_extract(publication_number, '([0-9]+)', 1) AS patent_id, min(pos) AS pos
  FROM external WHERE publication_number IS NOT NULL GROUP BY 1)"""
NUMBERS = """
numbers AS (
  SELECT p_partkey::BIGINT AS item,
         CASE p_partkey % 6
           WHEN 0 THEN concat('US', lpad(p_partkey::VARCHAR, 7, '0'), 'B2')
           WHEN 1 THEN concat('US2006', lpad(p_partkey::VARCHAR, 7, '0'), 'A1')
           WHEN 2 THEN concat('USD', lpad(p_partkey::VARCHAR, 6, '0'), 'S1')
           WHEN 3 THEN concat(' EP', lpad(p_partkey::VARCHAR, 7, '0'), 'A1 ')
           WHEN 4 THEN 'US1' END AS publication_number
  FROM part)"""
BATCHES = f"""{CLEANED}, {CORPUS},
meta AS (
  SELECT (row_id // 64)::INTEGER AS batch_id, row_id % 64 AS pos, patent_id, cleaned_claim
  FROM cleaned),
vectors AS (SELECT (row_id // 64)::INTEGER AS batch_id, row_id % 64 AS pos, v FROM corpus),
paired AS (
  SELECT batch_id, meta_rows, vector_rows,
         CASE WHEN meta_rows IS NULL OR vector_rows IS NULL THEN 'missing'
              WHEN meta_rows <> vector_rows THEN 'mismatch' ELSE 'ok' END AS status
  FROM (SELECT batch_id, count(*) AS meta_rows FROM meta GROUP BY 1)
  FULL JOIN (SELECT batch_id, count(*) AS vector_rows FROM vectors GROUP BY 1) USING (batch_id)),
zipped AS (
  SELECT batch_id, pos, patent_id, cleaned_claim, v
  FROM meta JOIN vectors USING (batch_id, pos) JOIN paired USING (batch_id)
  WHERE status = 'ok')"""


def hashed(name: str, source: str, key: str, text: str, dim: int = 64) -> str:
    """CTE ``name(key, v)``: unit vectors of signed word hashes; texts without words are absent."""
    return f"""
{name}_words AS (
  SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS w
  FROM {source} WHERE {text} IS NOT NULL),
{name}_buckets AS (
  SELECT {key}, h % {dim} AS b, sum(CASE WHEN (h // {dim}) % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS c
  FROM (SELECT {key}, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h FROM {name}_words WHERE w <> '')
  GROUP BY 1, 2),
{name}_norms AS (
  SELECT {key}, sqrt(sum(c * c)) AS n FROM {name}_buckets GROUP BY 1 HAVING sum(c * c) > 0),
{name} AS MATERIALIZED (
  SELECT g.{key}, list(CAST(coalesce(c, 0) / n AS FLOAT)::DOUBLE ORDER BY d) AS v
  FROM (SELECT {key}, n, d FROM {name}_norms, range({dim}) AS r(d)) AS g
  LEFT JOIN {name}_buckets AS k ON k.{key} = g.{key} AND k.b = g.d
  GROUP BY 1)"""


def values(vector: str = "v") -> str:
    """All values of a vector in order, as text with six decimals."""
    return f"array_to_string(list_transform({vector}, lambda x: printf('%.6f', x)), ',') AS vector_values"


INNER = "list_inner_product(q.v, c.v)"
L2 = "pow(list_distance(q.v, c.v), 2)"


def hits(name: str, queries: str, corpus: str, score: str = INNER, condition: str = "true") -> str:
    """CTE of all scored pairs with their rank."""
    way = "DESC" if score == INNER else "ASC"
    return f"""
{name} AS MATERIALIZED (
  SELECT query_id, row_id, patent_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) {way}, row_id) AS rank
  FROM (SELECT q.query_id, c.row_id, c.patent_id, {score} AS score
        FROM {queries} AS q, {corpus} AS c WHERE {condition}))"""


QUERIES = "queries AS (SELECT row_id AS query_id, patent_id, label, v FROM corpus)"
VECTOR_SEARCH = f"WITH {CORPUS}, {QUERIES}"


def distinct_hits(k: int, fetched: int | None, group: str = "patent_id") -> str:
    limit = "" if fetched is None else f"WHERE rank <= {fetched}"
    return f"""
firsts AS (
  SELECT query_id, {group}, min(rank) AS best FROM hits {limit} GROUP BY 1, 2),
top AS (
  SELECT h.query_id, h.row_id, h.{group}, h.score, p.place
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY best) AS place FROM firsts) AS p
  JOIN hits AS h ON h.query_id = p.query_id AND h.rank = p.best
  WHERE p.place <= {k})"""


TOP_COLUMNS = "query_id, rank::INTEGER AS rank, row_id, round(score, 6) + 0.0 AS score"


def label_hits(fetched: int | None) -> str:
    """Search with the label in the place of the patent."""
    labelled = "(SELECT row_id, label::VARCHAR AS patent_id, v FROM corpus)"
    return f"""{VECTOR_SEARCH}, {hits("hits", "queries", labelled)}, {distinct_hits(5, fetched)}
SELECT query_id, place::INTEGER AS rank, row_id, patent_id::INTEGER AS label,
       round(score, 6) + 0.0 AS score FROM top"""


RETRIEVAL = f"""{CLEANED},
{hashed("claim_vectors", "cleaned", "row_id", "cleaned_claim")},
{hashed("raw_vectors", "claims", "row_id", "claim_text")},
asked AS (SELECT row_id AS query_id, v FROM raw_vectors),
stored AS (SELECT row_id, patent_id, v FROM claim_vectors JOIN claims USING (row_id)),
{hits("hits", "asked", "stored")}, {distinct_hits(10, 50)},
packed AS (
  SELECT query_id, string_agg(patent_id, ' | ' ORDER BY place) AS top_patents,
         string_agg(printf('%.4f', score), ' | ' ORDER BY place) AS similarities
  FROM top GROUP BY 1),
checked AS (
  SELECT c.row_id AS query_id, c.patent_id, c.claim_text AS claim,
         coalesce(p.top_patents, '') AS top_patents, coalesce(p.similarities, '') AS similarities,
         CASE WHEN list_contains(string_split(p.top_patents, ' | '), c.patent_id) THEN 'Y'
              ELSE 'N' END AS found_itself
  FROM claims AS c LEFT JOIN packed AS p ON p.query_id = c.row_id)"""

LISTS = f"""{EXTERNAL},
numbered AS (
  SELECT query_id, pos, nullif(regexp_extract(publication_number, '^[A-Z]{{2}}([0-9]+)', 1), '') AS number
  FROM external),
uniques AS (
  SELECT query_id, number, min(pos) AS pos FROM numbered WHERE number IS NOT NULL GROUP BY 1, 2),
top_numbers AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY pos, number) AS rank FROM uniques)
  WHERE rank <= 100),
lists AS (
  SELECT query_id, string_agg(number, ' | ' ORDER BY rank) AS external_patents,
         list(number) AS numbers
  FROM top_numbers GROUP BY 1)"""

CENTROIDS = f"""{CORPUS},
centroids AS MATERIALIZED (
  SELECT label AS cell, list(m ORDER BY d) AS v
  FROM (SELECT label, d, avg(v[d]) AS m FROM corpus, range(1, 65) AS r(d) GROUP BY 1, 2) GROUP BY 1),
celled AS (
  SELECT row_id, patent_id, v, cell, place FROM (
    SELECT c.row_id, c.patent_id, c.v, t.cell,
           row_number() OVER (PARTITION BY c.row_id
             ORDER BY round(list_inner_product(c.v, t.v), 6) DESC, t.cell) AS place
    FROM corpus AS c, centroids AS t))"""


def cell_search(nprobe: int, k: int) -> str:
    return f"""WITH {CENTROIDS},
stored AS (SELECT row_id, patent_id, v, cell FROM celled WHERE place = 1),
asked AS (SELECT row_id AS query_id, v, cell FROM celled WHERE place <= {nprobe}),
{hits("hits", "asked", "stored", INNER, "q.cell = c.cell")}
SELECT {TOP_COLUMNS} FROM hits WHERE rank <= {k}"""


FIRST_OF_LIST = f"""{LISTED}, {CORPUS},
joined AS (SELECT l.pos, c.* FROM listed AS l JOIN corpus AS c USING (patent_id)),
query AS (SELECT v FROM joined ORDER BY pos, row_id LIMIT 1)"""

HASH_ROWS = f"""WITH {CLEANED}, {hashed("coded", "cleaned", "row_id", "cleaned_claim")}
SELECT row_id, (d - 1)::INTEGER AS dim, round(v[d], 6) + 0.0 AS value
FROM cleaned LEFT JOIN coded USING (row_id) LEFT JOIN range(1, 65) AS r(d) ON v IS NOT NULL"""

SIDES = f"""{CLAIMS},
sided AS (
  SELECT c.patent_id, c.claim_text, CAST(substr(source, 4) AS INTEGER) % 2 = 0 AS in_a,
         {strip("c.claim_text")} AS tidy
  FROM claims AS c JOIN documents AS d ON d.doc_id = c.row_id)"""

PAIRS = "SELECT a.vec_id AS row_id, {} AS value FROM embeddings AS a JOIN embeddings AS b ON b.vec_id = a.vec_id // 2"


def sql() -> dict[str, str]:
    stripped_text = strip("text")
    out = {
        "read_claims": "SELECT doc_id, text FROM documents",
        "page_claims": f"""WITH {CLAIMS} SELECT row_id, patent_id, claim_no, claim_text FROM claims
            ORDER BY patent_id, claim_no OFFSET 100 LIMIT 50""",
        "page_deep": """SELECT o_orderkey, o_custkey FROM orders
            ORDER BY o_orderkey OFFSET 12000 LIMIT 500""",
        "page_indexed": """
            WITH placed AS (SELECT o_orderkey, o_custkey, o_totalprice, count(*) OVER () AS n,
                row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS place FROM orders),
            pages AS (SELECT 0 AS page, 0 AS first UNION ALL SELECT 1, count(*) // 2 FROM orders
              UNION ALL SELECT 2, count(*) - 20 FROM orders)
            SELECT o_orderkey, o_custkey, o_totalprice, page FROM placed JOIN pages ON place BETWEEN first AND first + 49""",
        "assign_batches": """SELECT doc_id, source, position, (position // 64)::INTEGER AS batch_id FROM (
            SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS position
            FROM documents)""",
        "assign_batches_resume": """
            SELECT doc_id, source, position, (3 + (position - 128) // 64)::INTEGER AS batch_id FROM (
            SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS position
            FROM documents) WHERE position >= 128""",
        "csv_round_trip": f"WITH {CLEANED} SELECT patent_id, nullif(cleaned_claim, '') AS cleaned_claim FROM cleaned",
        "write_batches": f"WITH {BATCHES} SELECT batch_id, pos, patent_id, cleaned_claim FROM meta",
        "append_vectors": f"""WITH {BATCHES}
            SELECT patent_id, cleaned_claim, {values()} FROM zipped""",
        "vector_table": f"WITH {BATCHES} SELECT patent_id, cleaned_claim, {values()} FROM zipped",
        "import_vector_files": f"WITH {BATCHES} SELECT batch_id, pos, {values()} FROM vectors",
        "import_batch_files": f"""WITH {BATCHES}
            SELECT batch_id, pos, patent_id, cleaned_claim, {values()} FROM zipped""",
        "load_batches": f"""WITH {BATCHES}
            SELECT batch_id, CASE WHEN batch_id = 3 AND status = 'ok' THEN 'failed' ELSE status END AS status,
              coalesce(meta_rows, 0) AS manifest_rows,
              CASE WHEN status = 'ok' AND batch_id <> 3 THEN meta_rows ELSE 0 END AS written_rows FROM paired""",
        "load_audit_real": f"""WITH {BATCHES},
            told AS (SELECT batch_id, coalesce(meta_rows, 0) AS listed,
              CASE WHEN status = 'ok' AND batch_id <> 3 THEN meta_rows ELSE 0 END AS written FROM paired),
            loads(load, low, high, stranger) AS (VALUES (0, 0, 1, 0), (1, 2, 1000000000, 0), (2, 1, 1, 1)),
            summed AS (SELECT load, sum(listed)::BIGINT AS expected, sum(written)::BIGINT AS reported,
                (sum(written) + max(stranger) * (SELECT count(*) FROM zipped WHERE batch_id = 0))::BIGINT AS delta
              FROM loads JOIN told ON batch_id BETWEEN low AND high GROUP BY 1)
            SELECT load, expected, reported, (sum(delta) OVER w - delta)::BIGINT AS before,
              (sum(delta) OVER w)::BIGINT AS after, delta,
              CASE WHEN delta <> reported THEN 'WARNING' WHEN reported <> expected THEN 'NOTE' ELSE 'OK' END AS verdict
            FROM summed WINDOW w AS (ORDER BY load)""",
        "pair_batches": f"WITH {BATCHES} SELECT batch_id, meta_rows, vector_rows, status FROM paired",
        "zip_rows_checked": f"WITH {BATCHES} SELECT batch_id, pos, patent_id, cleaned_claim, {values()} FROM zipped",
        "load_audit": f"""WITH {BATCHES}, totals AS (
            SELECT (SELECT count(*) FROM meta) AS expected, (SELECT count(*) FROM zipped) AS reported)
            SELECT expected, reported, 0::BIGINT AS before, reported AS after, reported AS delta,
            CASE WHEN reported <> expected THEN 'NOTE' ELSE 'OK' END AS verdict FROM totals""",
        "audit_totals": f"""WITH {BATCHES} SELECT (SELECT count(*) FROM meta) AS expected,
            (SELECT count(*) FROM zipped) AS reported""",
        "row_count": "SELECT count(*) AS rows FROM documents",
        "rows_per_batch": f"WITH {BATCHES} SELECT batch_id, count(*) AS rows FROM meta GROUP BY 1",
        "distinct_ids": f"WITH {CLAIMS} SELECT count(DISTINCT patent_id) AS ids FROM claims",
        "union_batches": """SELECT doc_id AS row_id, text FROM documents UNION ALL
            SELECT item_id, text FROM benchmark UNION ALL SELECT page_id, html FROM pages""",
        "ingest_incremental": f"""WITH {CLEANED}, {hashed("coded", "cleaned", "row_id", "cleaned_claim")}
            SELECT c.row_id, c.patent_id, c.claim_text, c.cleaned_claim, {values()}
            FROM cleaned AS c LEFT JOIN coded USING (row_id)""",
        "clean_claim": f"SELECT page_id, {clean('html')} AS cleaned FROM pages",
        "clean_claim_docs": f"WITH {CLEANED} SELECT row_id, cleaned_claim FROM cleaned",
        "blank_filter": f"""WITH {CLEANED} SELECT row_id, claim_text IS NULL OR
            {strip("claim_text")} = '' AS blank FROM cleaned""",
        "drop_blank": f"""SELECT doc_id FROM documents WHERE {stripped_text} <> ''""",
        "id_string": f"WITH {NUMBERS} SELECT item, item::VARCHAR AS id, {strip('publication_number')} AS number FROM numbers",
        "publication_digits": f"""WITH {NUMBERS} SELECT item,
            nullif(regexp_extract(publication_number, '^[A-Z]{{2}}([0-9]+)', 1), '') AS digits FROM numbers""",
        "publication_core": f"""WITH {NUMBERS}, tidy AS (
              SELECT item, upper({strip("publication_number")}) AS t FROM numbers)
            SELECT item, CASE WHEN length(t) >= 5 THEN nullif(regexp_replace(
              regexp_replace(substr(t, 3), '[A-Z][^A-Z]*$', ''), '[^0-9]', '', 'g'), '') END AS core
            FROM tidy""",
        "normalize_id": f"""WITH {NUMBERS}, tidy AS (
              SELECT item, regexp_replace(upper(publication_number), '[^A-Z0-9]', '', 'g') AS t FROM numbers)
            SELECT item, nullif(regexp_replace(regexp_replace(t, '^[A-Z]{{2,3}}0*', ''), '[A-Z].*$', ''), '')
              AS norm_id FROM tidy""",
        "filter_ids": f"""WITH {CLAIMS},
            good AS (SELECT DISTINCT CAST(1000000 + doc_id // 4 AS VARCHAR) AS patent_id FROM labels WHERE quality = 1),
            bad AS (SELECT DISTINCT CAST(1000000 + doc_id // 4 AS VARCHAR) AS patent_id FROM labels WHERE toxic = 1)
            SELECT row_id, patent_id, claim_text, in_a, in_b FROM (
              SELECT *, patent_id IN (SELECT patent_id FROM good) AS in_a,
                     patent_id IN (SELECT patent_id FROM bad) AS in_b FROM claims)
            WHERE in_a OR in_b""",
        "l2_normalize": """SELECT vec_id AS row_id, (d - 1)::INTEGER AS dim,
            round((v[d] / sqrt(list_sum(list_transform(v, lambda x: x * x))))::FLOAT::DOUBLE, 6) + 0.0 AS value
            FROM (SELECT vec_id, list_transform(embedding, lambda x: (x * 3::FLOAT)::DOUBLE) AS v
                  FROM embeddings), range(1, 65) AS r(d)""",
        "vector_dim": "SELECT vec_id AS row_id, len(embedding)::INTEGER AS dim FROM embeddings",
        "inner_product": PAIRS.format(
            "round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) + 0.0"),
        "l2_sq": PAIRS.format(
            "round(pow(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 2), 6) + 0.0"),
        "cosine": PAIRS.format(
            "round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) + 0.0"),
        "fmt4": """SELECT l_orderkey, l_linenumber, printf('%.4f', l_extendedprice / 7) AS price
            FROM lineitem""",
        "parse_vector": f"""SELECT vec_id AS row_id, len(embedding)::INTEGER AS dim,
            {values("embedding::DOUBLE[]")} FROM embeddings""",
        "project_columns": f"""WITH {CLAIMS} SELECT claim_text AS claim, patent_id,
            NULL::VARCHAR AS top_patents, NULL::VARCHAR AS found_itself FROM claims""",
        "drop_nulls": f"WITH {EXTERNAL} SELECT query_id, pos, publication_number FROM external WHERE publication_number IS NOT NULL",
        "values_table": f"""WITH {CLAIMS},
            listed(patent_id, note) AS (VALUES ('1000000', 'first'), ('1000007', 'kept'), ('1000049', 'kept'),
              ('42', 'unknown'), (NULL, 'none'))
            SELECT l.patent_id, note, row_id FROM listed AS l LEFT JOIN claims AS c ON c.patent_id = l.patent_id""",
        "left_join_1n": f"""WITH {LISTED}, {CLEANED}
            SELECT l.patent_id, l.pos, c.row_id, c.cleaned_claim
            FROM listed AS l LEFT JOIN cleaned AS c ON c.patent_id = l.patent_id""",
        "exact_text_match": f"""WITH {SIDES}
            SELECT a.patent_id AS patent_a, b.patent_id AS patent_b, a.claim_text AS matched_claim
            FROM sided AS a JOIN sided AS b ON a.tidy = b.tidy WHERE a.in_a AND NOT b.in_a""",
        "match_groups": f"""WITH {SIDES}
            SELECT sha256(tidy) AS text_key, count(*) FILTER (in_a) AS rows_a,
              count(DISTINCT patent_id) FILTER (in_a) AS ids_a, min(patent_id) FILTER (in_a) AS first_a,
              count(*) FILTER (NOT in_a) AS rows_b, count(DISTINCT patent_id) FILTER (NOT in_a) AS ids_b,
              min(patent_id) FILTER (NOT in_a) AS first_b
            FROM sided WHERE tidy IS NOT NULL GROUP BY tidy
            HAVING count(*) FILTER (in_a) > 0 AND count(*) FILTER (NOT in_a) > 0""",
        "keep_in_list": f"""WITH {LISTED}, {CLAIMS} SELECT row_id, patent_id, claim_text FROM claims
            WHERE patent_id IN (SELECT patent_id FROM listed)""",
        "missing_ids": f"""WITH {LISTED}, {CLAIMS} SELECT patent_id FROM listed
            WHERE patent_id NOT IN (SELECT patent_id FROM claims)""",
        "id_difference": f"""WITH {LISTED}, {CORPUS} SELECT patent_id FROM listed
            EXCEPT SELECT patent_id FROM corpus""",
        "id_intersection": f"""WITH {LISTED}, {CORPUS} SELECT patent_id FROM listed
            INTERSECT SELECT patent_id FROM corpus""",
        "list_coverage": f"""WITH {LISTED}, {CORPUS} SELECT
            (SELECT count(DISTINCT patent_id) FROM listed) AS list_ids,
            (SELECT count(DISTINCT patent_id) FROM corpus) AS corpus_ids,
            (SELECT count(*) FROM listed WHERE patent_id NOT IN (SELECT patent_id FROM corpus)) AS missing_ids""",
        "first_n_unique": f"WITH {LISTS} SELECT query_id, number, pos, rank::INTEGER AS rank FROM top_numbers",
        "pack_lists": f"WITH {LISTS} SELECT query_id, external_patents, len(numbers)::INTEGER AS items FROM lists",
        "first_occurrence": f"""WITH {EXTERNAL} SELECT query_id, publication_number, min(pos) AS pos
            FROM external WHERE publication_number IS NOT NULL GROUP BY 1, 2""",
        "topk_inner": f"{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus')} SELECT {TOP_COLUMNS} FROM hits WHERE rank <= 10",
        "topk_l2": f"{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus', L2)} SELECT {TOP_COLUMNS} FROM hits WHERE rank <= 5",
        "attach_metadata": f"""{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus')}, {CLEANED}
            SELECT h.query_id, h.rank::INTEGER AS rank, h.row_id, c.patent_id, c.cleaned_claim
            FROM hits AS h JOIN cleaned AS c ON c.row_id = h.row_id WHERE h.rank <= 10""",
        "topk_distinct": f"""{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus')}, {distinct_hits(10, 50)}
            SELECT query_id, place::INTEGER AS rank, row_id, patent_id, round(score, 6) + 0.0 AS score FROM top""",
        "topk_distinct_short": label_hits(25),
        "topk_distinct_exact": label_hits(None),
        "pick_query": f"WITH {FIRST_OF_LIST} SELECT pos, row_id, patent_id FROM joined ORDER BY pos, row_id LIMIT 1",
        "rank_all": f"""WITH {FIRST_OF_LIST} SELECT c.row_id, c.patent_id,
            round(list_inner_product(q.v, c.v), 6) + 0.0 AS score FROM corpus AS c, query AS q""",
        "sort_desc": f"""WITH {FIRST_OF_LIST} SELECT row_id, score,
            row_number() OVER (ORDER BY score DESC, row_id) - 1 AS position FROM (
              SELECT c.row_id, round(list_inner_product(q.v, c.v), 6) + 0.0 AS score FROM corpus AS c, query AS q)""",
        "head": f"""WITH {FIRST_OF_LIST} SELECT row_id, score FROM (
              SELECT c.row_id, round(list_inner_product(q.v, c.v), 6) + 0.0 AS score FROM corpus AS c, query AS q)
            ORDER BY score DESC, row_id LIMIT 10""",
        "one_vs_list_ranked": f"""WITH {FIRST_OF_LIST} SELECT c.row_id, c.patent_id, c.patent_id AS norm_id,
            round(list_inner_product(q.v, c.v), 6) + 0.0 AS similarity FROM corpus AS c, query AS q
            WHERE c.patent_id IN (SELECT patent_id FROM listed)""",
        "one_vs_list_direct": f"""WITH {LISTED}, {CLEANED},
            {hashed("coded", "cleaned", "row_id", "cleaned_claim")},
            joined AS (SELECT l.pos, c.row_id, c.patent_id, c.cleaned_claim, v FROM listed AS l
              JOIN cleaned AS c USING (patent_id) JOIN coded USING (row_id)
              WHERE {strip("c.cleaned_claim")} <> ''),
            query AS (SELECT v FROM joined ORDER BY pos, row_id LIMIT 1)
            SELECT pos, row_id, patent_id, cleaned_claim,
              round(list_cosine_similarity(q.v, j.v), 6) + 0.0 AS similarity_to_first
            FROM joined AS j, query AS q""",
        "compare_metrics": f"""{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus')},
            {hits('far', 'queries', 'corpus', L2)},
            a AS (SELECT DISTINCT query_id, patent_id FROM hits WHERE rank <= 10),
            b AS (SELECT DISTINCT query_id, patent_id FROM far WHERE rank <= 10)
            SELECT query_id, count(a.patent_id) AS found_a, count(b.patent_id) AS found_b,
              count(*) FILTER (a.patent_id IS NOT NULL AND b.patent_id IS NOT NULL) AS agreed
            FROM a FULL JOIN b USING (query_id, patent_id) GROUP BY 1""",
        "cell_centroids": f"""WITH {CENTROIDS} SELECT cell, (d - 1)::INTEGER AS dim,
            round(v[d], 6) + 0.0 AS value FROM centroids, range(1, 65) AS r(d)""",
        "assign_cells": f"WITH {CENTROIDS} SELECT row_id, patent_id, cell FROM celled WHERE place = 1",
        "write_cells": f"WITH {CENTROIDS} SELECT row_id, patent_id, cell FROM celled WHERE place = 1",
        "probe_join": f"""WITH {CENTROIDS}, {LISTED},
            first AS (SELECT c.row_id FROM listed AS l JOIN corpus AS c USING (patent_id)
              ORDER BY l.pos, c.row_id LIMIT 1),
            near AS (SELECT cell FROM celled JOIN first USING (row_id) WHERE place <= 3)
            SELECT row_id, patent_id, cell FROM celled WHERE place = 1 AND cell IN (SELECT cell FROM near)""",
        "search_cells": cell_search(1, 10),
        "search_cells_nprobe": cell_search(3, 10),
        "search_trained_cells_all": f"{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus')} SELECT {TOP_COLUMNS} FROM hits WHERE rank <= 10",
        "search_trained_cells_all_l2": f"{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus', L2)} SELECT {TOP_COLUMNS} FROM hits WHERE rank <= 5",
        "search_cells_all": f"{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus')} SELECT {TOP_COLUMNS} FROM hits WHERE rank <= 10",
        "hash_encode": HASH_ROWS,
        "encode_text": HASH_ROWS,
        "encode_once": HASH_ROWS,
        "search_text": f"""WITH {CLEANED}, {hashed("stored_v", "cleaned", "row_id", "cleaned_claim")},
            asked_text AS (SELECT item_id AS query_id, text AS query FROM benchmark),
            {hashed("asked", "asked_text", "query_id", "query")},
            stored AS (SELECT row_id, patent_id, v FROM stored_v JOIN cleaned USING (row_id)),
            {hits("hits", "asked", "stored")}
            SELECT h.query_id, h.rank::INTEGER AS rank, a.query, h.patent_id, c.cleaned_claim,
              round(h.score, 6) + 0.0 AS score
            FROM hits AS h JOIN asked_text AS a USING (query_id) JOIN cleaned AS c ON c.row_id = h.row_id
            WHERE h.rank <= 10""",
        "self_retrieval": f"""WITH {RETRIEVAL}
            SELECT query_id, patent_id, claim, top_patents, found_itself FROM checked""",
        "self_retrieval_cells": f"""WITH {RETRIEVAL}
            SELECT query_id, patent_id, claim, top_patents, found_itself FROM checked""",
        "similarity_log": f"""WITH {RETRIEVAL}
            SELECT query_id, patent_id, claim, top_patents, similarities, found_itself FROM checked""",
        "attach_external": f"""WITH {CORPUS}, {LISTS} SELECT row_id AS query_id, patent_id, external_patents
            FROM corpus LEFT JOIN lists ON query_id = row_id""",
        "overlap_count": f"""WITH {LISTS}, {CORPUS}, known AS (
              SELECT label::BIGINT AS query_id, list(DISTINCT patent_id) AS ids FROM corpus GROUP BY 1)
            SELECT query_id, coalesce(len(list_intersect(ids, numbers)), 0)::INTEGER AS overlap
            FROM known LEFT JOIN lists USING (query_id)""",
        "stamped_result": f"""{VECTOR_SEARCH}, {hits('hits', 'queries', 'corpus')}
            SELECT query_id, rank::INTEGER AS rank, row_id, patent_id, round(score, 6) + 0.0 AS score
            FROM hits WHERE rank <= 5 AND query_id % 10 = 0""",
        "search_cells_recall": f"""WITH {CENTROIDS},
            {hits('exact', '(SELECT row_id AS query_id, v FROM corpus)', 'corpus')},
            stored AS (SELECT row_id, patent_id, v, cell FROM celled WHERE place = 1),
            asked AS (SELECT row_id AS query_id, v, cell, place FROM celled),
            pairs AS MATERIALIZED (SELECT q.query_id, c.row_id, q.place, list_inner_product(q.v, c.v) AS score
              FROM asked AS q JOIN stored AS c ON q.cell = c.cell),
            near AS (SELECT * FROM (
              SELECT p.nprobe, query_id, row_id, row_number() OVER (PARTITION BY p.nprobe, query_id
                ORDER BY round(score, 6) DESC, row_id) AS rank
              FROM pairs JOIN (VALUES (1), (3), (10)) AS p(nprobe) ON place <= p.nprobe) WHERE rank <= 10)
            SELECT p.nprobe, count(*) AS wanted, count(n.row_id) AS found, round(count(n.row_id) / count(*), 6) AS recall
            FROM (SELECT query_id, row_id FROM exact WHERE rank <= 10) AS e
            CROSS JOIN (VALUES (1), (3), (10)) AS p(nprobe)
            LEFT JOIN near AS n ON n.nprobe = p.nprobe AND n.query_id = e.query_id AND n.row_id = e.row_id
            GROUP BY 1""",
        "search_cells_until": f"""WITH {CENTROIDS},
            stored AS (SELECT c.row_id, label, c.v, cell FROM celled AS c JOIN corpus AS r USING (row_id) WHERE place = 1),
            asked AS (SELECT row_id AS query_id, v, cell, place FROM celled),
            pairs AS MATERIALIZED (SELECT q.query_id, c.row_id, c.label, q.place, list_inner_product(q.v, c.v) AS score
              FROM asked AS q JOIN stored AS c ON q.cell = c.cell),
            rounds(upto) AS (VALUES (1), (2), (4), (8), (10)),
            enough AS (SELECT query_id, min(CASE WHEN labels >= 8 OR upto = 10 THEN upto END) AS probed FROM (
              SELECT query_id, upto, count(DISTINCT label) AS labels FROM pairs JOIN rounds ON place <= upto GROUP BY 1, 2)
              GROUP BY 1),
            firsts AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY round(score, 6) DESC, row_id) AS nth
              FROM pairs JOIN enough USING (query_id) WHERE place <= probed),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, row_id) AS rank
              FROM firsts WHERE nth = 1)
            SELECT query_id, rank::INTEGER AS rank, row_id, label, round(score, 6) + 0.0 AS score, probed
            FROM ranked WHERE rank <= 8""",
        "assign_cells_tree": f"""WITH {CORPUS},
            flat AS (SELECT row_id, cell FROM (
              SELECT c.row_id, t.row_id AS cell, row_number() OVER (PARTITION BY c.row_id
                ORDER BY round(list_inner_product(c.v, t.v), 6) DESC, t.row_id) AS place
              FROM corpus AS c, corpus AS t WHERE t.row_id % 8 = 0) WHERE place = 1)
            SELECT count(*) AS rows, true AS agreed, count(*) AS same_whole, sum(cell)::BIGINT AS cells FROM flat""",
        "external_overlap": f"""WITH {RETRIEVAL}, {LISTS}
            SELECT query_id, patent_id, top_patents, found_itself, external_patents,
              coalesce(len(list_intersect(string_split(top_patents, ' | '), numbers)), 0)::INTEGER AS total_found
            FROM checked LEFT JOIN lists USING (query_id)""",
    }
    out["external_overlap_cells"] = out["external_overlap"]
    out["search_text_cells"] = out["search_text"]
    return out
