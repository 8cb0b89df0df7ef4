"""Queries of the core operators over the test tables, with the same results in DuckDB's SQL.

The SQL is written on its own, not derived from the operators. Queries whose result SQL can't say have none; the tests
hold them against brute force or against the tables.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import geometry, ranges, serving, text
from quirework.operators import assemble, labels, model, parse, progress, resume, toc
from quirework.session import read_table, scratch_folder
from quirework.sinks import outputs
from quirework.streaming import completion

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        if sql is not None:
            _SQL[query.__name__] = sql
        return query

    return register


#: One artifact per page, as the operators choose it.
_ONE = """
one AS (
  SELECT * EXCLUDE (rank_no) FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY coalesce(error, false), coalesce(token_count, 0) DESC, length(markdown) DESC, md5(markdown) DESC) AS rank_no
    FROM page_artifacts) WHERE rank_no = 1)
"""


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "page_artifacts")


@_query(f"""
WITH {_ONE}, p AS (SELECT doc_id, page_num // 2000 AS part, count(*) AS n_pages, string_agg(coalesce(markdown, ''), chr(10) || chr(10) ORDER BY page_num) AS m,
  string_agg(coalesce(html_filtered, ''), chr(10) || chr(10) ORDER BY page_num) AS h FROM one GROUP BY ALL),
f AS (SELECT *, CASE WHEN part = min(part) OVER (PARTITION BY doc_id) THEN '' ELSE chr(10) || chr(10) END AS gap FROM p)
SELECT doc_id, part, n_pages, md5(gap || m) AS markdown_md5, length(gap || h) AS html_chars FROM f
""")
def assemble_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document merged in page order, in parts of bounded size; most have one."""
    parts = assemble.assemble_parts(_artifacts(spark, sf_dir))
    return parts.select("doc_id", "part", "n_pages", F.md5("markdown").alias("markdown_md5"), F.length("html").alias("html_chars"))


@_query(f"""
WITH {_ONE}, placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_num) - 1 AS i FROM one)
SELECT doc_id,
  md5(string_agg(CASE WHEN i = 0 THEN markdown ELSE chr(10) || chr(10) || i || repeat('-', 48) || chr(10) || chr(10) || markdown END, '' ORDER BY i)) AS markdown_md5,
  md5(string_agg(CASE WHEN i = 0 THEN html_filtered ELSE chr(10) || chr(10) || '<!-- Page ' || (i + 1) || ' -->' || chr(10) || chr(10) || html_filtered END, '' ORDER BY i)) AS html_md5
FROM placed GROUP BY doc_id
""")
def assemble_paginated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document merged with page separators."""
    merged = assemble.assemble(_artifacts(spark, sf_dir), paginated=True)
    return merged.select("doc_id", F.md5("markdown").alias("markdown_md5"), F.md5("html").alias("html_md5"))


@_query(f"""
WITH {_ONE}
SELECT doc_id, page_num // 10 AS part, count(*) AS n_pages, sum(length(markdown)) AS markdown_chars FROM one GROUP BY ALL
""")
def document_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of ten page numbers of every document, and how much text of pages is in them."""
    parts = assemble.assemble_parts(_artifacts(spark, sf_dir), part_pages=10)
    chars = F.length("markdown") - 2 * (F.col("n_pages") - F.when(F.row_number().over(_first_part()) == 1, 1).otherwise(0))
    return parts.select("doc_id", "part", "n_pages", chars.alias("markdown_chars"))


def _first_part():  # noqa: ANN202
    from pyspark.sql import Window

    return Window.partitionBy("doc_id").orderBy("part")


@_query(f"""
WITH {_ONE}
SELECT doc_id, count(*) AS num_pages, sum(coalesce(token_count, 0))::BIGINT AS total_token_count, sum(coalesce(len(chunks), 0))::BIGINT AS total_chunks,
       sum(coalesce(len(image_files), 0))::BIGINT AS total_images, count(*) FILTER (WHERE error) AS failed_pages
FROM one GROUP BY doc_id
""")
def document_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of every document."""
    return assemble.document_metadata(_artifacts(spark, sf_dir))


@_query(f"""
WITH {_ONE}
SELECT doc_id, page_num, array_to_string(page_box, ' ') AS page_box, coalesce(token_count, 0) AS token_count, coalesce(len(chunks), 0) AS num_chunks,
       coalesce(len(image_files), 0) AS num_images, error
FROM one
""")
def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of every page."""
    return assemble.page_metadata(_artifacts(spark, sf_dir)).withColumn("page_box", F.array_join("page_box", " "))


@_query(f"""
WITH {_ONE}, c AS (SELECT doc_id, page_num, unnest(chunks) AS k, generate_subscripts(chunks, 1) - 1 AS position FROM one)
SELECT doc_id, page_num, position, k.label AS label, k.chunk_id AS chunk_id, md5(k.content) AS content_md5, k.image_ref AS image_ref FROM c
""")
def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of all pages with their place."""
    chunks = assemble.document_chunks(_artifacts(spark, sf_dir))
    return chunks.select("doc_id", "page_num", "position", "label", "chunk_id", F.md5("content").alias("content_md5"), "image_ref")


@_query("""
WITH e AS (SELECT DISTINCT doc_id, unnest(expected_pages) AS page_num FROM run_state)
SELECT doc_id, page_num FROM e WHERE NOT EXISTS (SELECT 1 FROM page_artifacts a WHERE a.doc_id = e.doc_id AND a.page_num = e.page_num)
""")
def pending_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected pages that have no artifact."""
    return resume.pending_pages(resume.expected_pages(read_table(spark, sf_dir, "run_state")), _artifacts(spark, sf_dir))


@_query("""
WITH e AS (SELECT DISTINCT doc_id, unnest(expected_pages) AS page_num FROM run_state), d AS (SELECT DISTINCT doc_id, page_num FROM page_artifacts)
SELECT e.doc_id, count(*) AS n_expected, count(d.page_num) AS n_done, count(*) = count(d.page_num) AS complete
FROM e LEFT JOIN d USING (doc_id, page_num) GROUP BY e.doc_id
""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are complete."""
    return resume.completeness(resume.expected_pages(read_table(spark, sf_dir, "run_state")), _artifacts(spark, sf_dir))


@_query(f"""
WITH {_ONE}, e AS (SELECT DISTINCT doc_id, unnest(expected_pages) AS page_num FROM run_state), d AS (SELECT DISTINCT doc_id, page_num FROM page_artifacts)
SELECT (SELECT count(DISTINCT doc_id) FROM e) AS books, (SELECT count(*) FROM e SEMI JOIN d USING (doc_id, page_num)) AS pages_processed,
       (SELECT count(*) FROM e ANTI JOIN d USING (doc_id, page_num)) AS pages_pending, (SELECT count(*) FROM one WHERE error) AS pages_failed
""")
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the whole run."""
    return assemble.run_statistics(completeness(spark, sf_dir), _artifacts(spark, sf_dir))


@_query("""
SELECT s.doc_id, s.run_no,
       max(coalesce(s.source.size = f.length AND abs(s.source.mtime - epoch_us(f.modification_time) / 1e6) < 1.0, false)) AS matches
FROM run_state s LEFT JOIN source_files f USING (doc_id) GROUP BY s.doc_id, s.run_no
""")
def source_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sources are as the runs recorded them."""
    return resume.fingerprints(read_table(spark, sf_dir, "source_files"), read_table(spark, sf_dir, "run_state"))


@_query("""
WITH m AS (
  SELECT s.doc_id, max(coalesce(s.source.size = f.length AND abs(s.source.mtime - epoch_us(f.modification_time) / 1e6) < 1.0, false)) AS ok
  FROM run_state s LEFT JOIN source_files f USING (doc_id) GROUP BY s.doc_id)
SELECT a.doc_id, count(*) AS n_artifacts FROM page_artifacts a JOIN m ON a.doc_id = m.doc_id AND m.ok GROUP BY a.doc_id
""")
def current_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts of documents whose source hasn't changed, by document."""
    kept = resume.drop_stale(_artifacts(spark, sf_dir), source_fingerprints(spark, sf_dir))
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_artifacts"))


@_query(f"""
WITH {_ONE}, s AS (SELECT doc_id, max_by(source, run_no * 100000 + len(expected_pages)) AS source FROM run_state WHERE source IS NOT NULL GROUP BY doc_id),
fin AS (SELECT o.doc_id, s.source.size AS size, s.source.mtime AS mtime FROM (SELECT doc_id FROM one GROUP BY doc_id HAVING sum(length(markdown)) > 0) o JOIN s USING (doc_id))
SELECT DISTINCT f.doc_id, f.path FROM source_files f
WHERE NOT EXISTS (SELECT 1 FROM fin WHERE fin.doc_id = f.doc_id AND fin.size = f.length AND abs(fin.mtime - epoch_us(f.modification_time) / 1e6) < 1.0)
""")
def unfinished_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source files that have no finished output made from the same file."""
    files = read_table(spark, sf_dir, "source_files").select("doc_id", "path", F.col("length").alias("size"), (F.unix_micros("modification_time") / 1e6).alias("mtime"))
    chars = assemble.one_per_page(_artifacts(spark, sf_dir), {"n": F.length("markdown")}).groupBy("doc_id").agg(F.sum("n").alias("n_chars"))
    states = resume.latest_state(read_table(spark, sf_dir, "run_state").where("source is not null"))
    finished = chars.join(states.select("doc_id", "size", "mtime"), "doc_id")
    return resume.unfinished(files, finished).select("doc_id", "path").distinct()


@_query(r"""
WITH b AS (SELECT DISTINCT doc_id, page_num, block_idx, md5(content) AS content_md5 FROM layout_blocks), s AS (SELECT doc_id, min(stem) AS stem FROM source_files GROUP BY doc_id),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY block_idx, content_md5) - 1 AS i FROM b)
SELECT doc_id, page_num, block_idx, content_md5,
  CASE WHEN stem IS NULL OR page_num IS NULL THEN '_/' || lpad(i::VARCHAR, 3, '0')
       ELSE coalesce(nullif(trim(regexp_replace(stem, '[^\p{L}\p{N}_-]+', '-', 'g'), '-'), ''), '_') || '/' || lpad(page_num::VARCHAR, 4, '0') || '/' || lpad(i::VARCHAR, 3, '0') END AS chunk_id
FROM n LEFT JOIN s USING (doc_id)
""")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable names of all layout blocks."""
    from pyspark.sql import Window

    blocks = read_table(spark, sf_dir, "layout_blocks").select("doc_id", "page_num", "block_idx", F.md5("content").alias("content_md5")).distinct()
    stems = read_table(spark, sf_dir, "source_files").groupBy("doc_id").agg(F.min("stem").alias("stem"))
    order = Window.partitionBy("doc_id", "page_num").orderBy("block_idx", "content_md5")
    placed = blocks.withColumn("i", F.row_number().over(order) - 1).join(stems, "doc_id", "left")
    return placed.select("doc_id", "page_num", "block_idx", "content_md5", text.chunk_id(F.col("stem"), F.col("page_num"), F.col("i")).alias("chunk_id"))


@_query("SELECT doc_id, md5(text) || '_' || (doc_id % 7 + 1) || '_img.webp' AS image_name FROM documents")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image file names made from texts."""
    return read_table(spark, sf_dir, "documents").select("doc_id", text.image_name(F.col("text"), F.col("doc_id") % 7 + 1).alias("image_name"))


@_query("""SELECT doc_id, page_num, nullif(regexp_extract(html_filtered, 'src="([^"]+\\.webp)"', 1), '') AS image_ref, count(*) AS n FROM page_artifacts GROUP BY ALL""")
def image_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First image that each page's HTML refers to."""
    return _artifacts(spark, sf_dir).groupBy("doc_id", "page_num", text.image_ref(F.col("html_filtered")).alias("image_ref")).agg(F.count("*").alias("n"))


@_query(r"""
WITH raws AS (SELECT doc_id, page_num, page_box[3] AS w, page_box[4] AS h, unnest(regexp_extract_all(raw_html, 'data-bbox="([^"]*)"', 1)) AS raw FROM page_artifacts),
p AS (SELECT *, string_split(raw, ' ') AS s FROM raws),
q AS (SELECT doc_id, page_num, raw, w, h, CASE WHEN len(s) = 4 AND len(list_filter(s, lambda x: NOT regexp_full_match(x, '[+-]?[0-9]+'))) = 0 THEN list_transform(s, lambda x: x::INT) ELSE [0, 0, 1000, 1000] END AS b FROM p)
SELECT doc_id, page_num, raw, greatest(0, trunc(b[1] * (w / 1000.0::DOUBLE)))::INT AS x0, greatest(0, trunc(b[2] * (h / 1000.0::DOUBLE)))::INT AS y0,
       least(trunc(b[3] * (w / 1000.0::DOUBLE)), w)::INT AS x1, least(trunc(b[4] * (h / 1000.0::DOUBLE)), h)::INT AS y1, count(*) AS n
FROM q GROUP BY ALL
""")
def pixel_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of the raw model output in pixels."""
    raws = _artifacts(spark, sf_dir).select("doc_id", "page_num", F.get("page_box", F.lit(2)).alias("w"), F.get("page_box", F.lit(3)).alias("h"), F.explode(F.regexp_extract_all("raw_html", F.lit('data-bbox="([^"]*)"'), F.lit(1))).alias("raw"))
    boxed = raws.withColumn("b", geometry.pixel_bbox(F.col("raw"), F.col("w"), F.col("h")))
    return boxed.groupBy("doc_id", "page_num", "raw", *[F.get("b", F.lit(k)).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))]).agg(F.count("*").alias("n"))


@_query("""
SELECT doc_id, run_no, array_to_string(list_transform(list_sort(list_distinct(expected_pages)), lambda p: p::VARCHAR), ' ') AS pages, len(list_distinct(expected_pages)) AS n
FROM run_state WHERE len(expected_pages) > 0 GROUP BY ALL
""")
def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected pages written as users write ranges, and read back."""
    states = read_table(spark, sf_dir, "run_state").where(F.size("expected_pages") > 0).select("doc_id", "run_no", text.page_list(F.col("expected_pages")).alias("spec")).distinct()
    parsed = states.withColumn("p", ranges.page_range_or_fail(F.col("spec")))
    return parsed.select("doc_id", "run_no", F.array_join(F.transform("p", lambda x: x.cast("string")), " ").alias("pages"), F.size("p").alias("n")).distinct()


@_query("""
WITH b AS (SELECT DISTINCT doc_id, page_num, block_idx, label, content FROM layout_blocks)
SELECT doc_id, page_num, block_idx, label, label || ' #' || row_number() OVER (PARTITION BY doc_id, page_num, label ORDER BY block_idx, content) AS caption FROM b
""")
def label_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with the running number of their label on the page."""
    return labels.numbered(read_table(spark, sf_dir, "layout_blocks")).select("doc_id", "page_num", "block_idx", "label", "caption")


@_query("""
SELECT label, coalesce(c, '#FF00FF') AS color, count(*) AS n
FROM layout_blocks LEFT JOIN (VALUES ('Section-Header','#4ECDC4'), ('Text','#45B7D1'), ('List-Group','#96CEB4'), ('Table','#FFEAA7'), ('Figure','#DDA15E'), ('Image','#BC6C25'),
  ('Caption','#C77DFF'), ('Equation','#9D4EDD'), ('Page-Header','#E0AFA0'), ('Page-Footer','#D4A5A5'), ('Footnote','#A8DADC'), ('Form','#F4A261')) AS t(l, c) ON label = l
GROUP BY ALL
""")
def label_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks per label with its colour."""
    return labels.coloured(read_table(spark, sf_dir, "layout_blocks")).groupBy("label", "color").agg(F.count("*").alias("n"))


@_query("""
SELECT doc_id, count(*) FILTER (WHERE label NOT IN ('Blank-Page', 'Page-Header', 'Page-Footer')) AS n_body, count(*) FILTER (WHERE label NOT IN ('Blank-Page', 'Image', 'Figure')) AS n_without_images,
       count(*) FILTER (WHERE label IN ('Image', 'Figure') AND contains(content, '<img') AND bbox[3] > bbox[1] AND bbox[4] > bbox[2]) AS n_crops,
       count(*) FILTER (WHERE bbox[3] > bbox[1] AND bbox[4] > bbox[2]) AS n_drawable
FROM layout_blocks GROUP BY doc_id HAVING n_body + n_without_images + n_crops + n_drawable > 0
""")
def block_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many blocks of each document pass each filter."""
    blocks = read_table(spark, sf_dir, "layout_blocks")
    parts = {
        "n_body": labels.select_blocks(blocks), "n_without_images": labels.select_blocks(blocks, headers_footers=True, images=False),
        "n_crops": labels.croppable(blocks), "n_drawable": labels.drawable(blocks),
    }
    long = None
    for name, rows in parts.items():
        one = rows.select("doc_id", F.lit(name).alias("kind"))
        long = one if long is None else long.unionByName(one)
    return long.groupBy("doc_id").agg(*[F.count_if(F.col("kind") == n).alias(n) for n in parts])


@_query("""
WITH d AS (SELECT DISTINCT request_id, doc_id, page_num, finished_at, error FROM generation_results WHERE raw IS NOT NULL AND raw <> ''),
t AS (SELECT doc_id, count(*) AS total FROM d GROUP BY doc_id),
n AS (SELECT d.*, total, row_number() OVER (PARTITION BY d.doc_id ORDER BY finished_at NULLS FIRST, page_num, request_id) AS n_done FROM d JOIN t USING (doc_id))
SELECT request_id, doc_id, page_num, n_done FROM n WHERE n_done % 5 = 0 OR n_done = total
""")
def progress_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls at which a run that reports every fifth page would have reported."""
    done = read_table(spark, sf_dir, "generation_results").where("raw is not null and raw <> ''").select("request_id", "doc_id", "page_num", "finished_at", "error").distinct()
    totals = done.groupBy("doc_id").agg(F.count("*").alias("total")).withColumn("already_done", F.lit(0))
    from quirework.operators.ordinals import running_number

    numbered = running_number(done, ["doc_id"], F.date_trunc("hour", F.col("finished_at")), [F.col("finished_at").asc_nulls_first(), "page_num", "request_id"], "n_done")
    return numbered.join(totals, "doc_id").where((F.col("n_done") % 5 == 0) | (F.col("n_done") == F.col("total"))).select("request_id", "doc_id", "page_num", "n_done")


_HEADINGS_OF = r"""
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM SOURCE),
fenced AS (SELECT *, regexp_matches(line, '^\s*```') AS fence, sum(regexp_matches(line, '^\s*```')::INT) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) % 2 AS code FROM lines),
found AS (SELECT doc_id, n, length(regexp_extract(line, '^(#{1,3})\s+(.+?)\s*$', 1)) AS level, trim(regexp_replace(regexp_extract(line, '^(#{1,3})\s+(.+?)\s*$', 2), '(\*\*|__|\*|_)', '', 'g')) AS heading
  FROM fenced WHERE NOT fence AND code = 0 AND regexp_matches(line, '^#{1,3}\s+\S')),
based AS (SELECT *, coalesce(nullif(trim(regexp_replace(regexp_replace(lower(heading), '[^\p{L}\p{N}_\s-]', '', 'g'), '[\s_]+', '-', 'g'), '-'), ''), 'section') AS base FROM found WHERE heading <> ''),
anchored AS (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY n) - 1 AS k FROM based)
"""
_HEADINGS = _HEADINGS_OF.replace("SOURCE", "documents")


@_query(f"WITH {_HEADINGS} SELECT doc_id, level, heading, CASE WHEN k = 0 THEN base ELSE base || '-' || k END AS anchor FROM anchored")
def toc_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of all documents with their anchors."""
    return toc.headings(read_table(spark, sf_dir, "documents")).select("doc_id", "level", "heading", "anchor")


@_query(f"WITH {_HEADINGS} SELECT doc_id, level, count(*) AS n FROM anchored GROUP BY ALL")
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings per level of all documents."""
    return toc.levels(toc.headings(read_table(spark, sf_dir, "documents")))


@_query(f"""
WITH {_HEADINGS}, t AS (SELECT doc_id, min(level) AS top FROM anchored GROUP BY doc_id)
SELECT doc_id, md5('# Table of Contents' || chr(10) || chr(10) || string_agg(repeat('  ', (level - top)::INT) || '- [' || heading || '](#' || CASE WHEN k = 0 THEN base ELSE base || '-' || k END || ')', chr(10) ORDER BY n) || chr(10) || chr(10)) AS toc_md5
FROM anchored JOIN t USING (doc_id) GROUP BY doc_id
""")
def toc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table of contents of every document."""
    return toc.contents(toc.headings(read_table(spark, sf_dir, "documents"))).select("doc_id", F.md5("toc").alias("toc_md5"))


_LOOPS = """
tails AS (SELECT DISTINCT request_id, right(raw, 1250) AS a, CASE WHEN length(raw) > 50 THEN right(left(raw, length(raw) - 50), 1250) ELSE '' END AS b FROM generation_results WHERE raw IS NOT NULL)
"""
_LOOP_TEST = "len(list_filter(range(1, 251), lambda u: length({t}) >= u * (5 + 12 // u) AND right({t}, u * (5 + 12 // u)) = repeat(right({t}, u), (5 + 12 // u)))) > 0"


@_query(f"WITH {_LOOPS} SELECT request_id FROM tails WHERE {_LOOP_TEST.format(t='a')} OR {_LOOP_TEST.format(t='b')}")
def degenerate_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls whose answer ends in a loop."""
    return model.retry_decisions(read_table(spark, sf_dir, "generation_results")).where("degenerate").select("request_id").distinct()


@_query(f"""
WITH {_LOOPS}, l AS (SELECT request_id FROM tails WHERE {_LOOP_TEST.format(t='a')} OR {_LOOP_TEST.format(t='b')})
SELECT DISTINCT g.request_id, (coalesce(g.error, false) OR l.request_id IS NOT NULL) AND g.attempt - 1 < 2 AS retry
FROM generation_results g LEFT JOIN l USING (request_id)
""")
def retry_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each call would be made again with two retries."""
    return model.retry_decisions(read_table(spark, sf_dir, "generation_results"), 2).select("request_id", "retry").distinct()


@_query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY attempt DESC, request_id DESC) AS k FROM generation_results)
SELECT doc_id, page_num, request_id, token_count, error, md5(raw) AS raw_md5 FROM r WHERE k = 1
""")
def accepted_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call that became each page."""
    return model.accepted_calls(read_table(spark, sf_dir, "generation_results")).select("doc_id", "page_num", "request_id", "token_count", "error", F.md5("raw").alias("raw_md5"))


@_query("""
WITH c AS (SELECT DISTINCT doc_id, page_num, request_id, error FROM generation_results)
SELECT doc_id, page_num, count(*) AS n_calls, count(*) FILTER (WHERE error) AS n_failed FROM c GROUP BY ALL
""")
def attempts_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and failed calls per page."""
    return model.attempts_per_page(read_table(spark, sf_dir, "generation_results"))


@_query("""
SELECT error_kind, CASE WHEN error_kind IN ('auth', 'http_4xx') THEN false ELSE true END AS retryable, count(*) AS n FROM generation_results WHERE error_kind IS NOT NULL GROUP BY ALL
""")
def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed calls per class of error."""
    failed = read_table(spark, sf_dir, "generation_results").where("error_kind is not null")
    return failed.groupBy("error_kind", serving.is_retryable(F.col("error_kind")).alias("retryable")).agg(F.count("*").alias("n"))


@_query("""
WITH s AS (SELECT DISTINCT page_box[3] AS w, page_box[4] AS h FROM page_artifacts),
f AS (SELECT w, h, CASE WHEN w * h > 3072 * 2048 THEN sqrt(3072.0 * 2048 / (w * h)) WHEN w * h < 1792 * 28 AND w * h > 0 THEN sqrt(1792.0 * 28 / (w * h)) ELSE 1.0 END AS k FROM s)
SELECT w AS width, h AS height, CASE WHEN w > 0 AND h > 0 THEN greatest(1, round_even(w * k / 28, 0))::INT * 28 ELSE w END AS fit_width,
       CASE WHEN w > 0 AND h > 0 THEN greatest(1, round_even(h * k / 28, 0))::INT * 28 ELSE h END AS fit_height FROM f
""")
def fitted_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes that the pages' images are brought to. The SQL holds as long as rounding stays within the bounds."""
    sizes = _artifacts(spark, sf_dir).select(F.get("page_box", F.lit(2)).alias("width"), F.get("page_box", F.lit(3)).alias("height")).distinct()
    return sizes.withColumn("s", geometry.fit_to_grid("width", "height")).select("width", "height", F.col("s.width").alias("fit_width"), F.col("s.height").alias("fit_height"))


@_query("""
WITH s AS (SELECT DISTINCT page_box[3] AS w, page_box[4] AS h FROM page_artifacts)
SELECT w AS width, h AS height, CASE WHEN least(w, h) BETWEEN 1 AND 1535 THEN trunc(w * (1536.0::DOUBLE / nullif(least(w, h), 0)))::INT ELSE w END AS load_width,
       CASE WHEN least(w, h) BETWEEN 1 AND 1535 THEN trunc(h * (1536.0::DOUBLE / nullif(least(w, h), 0)))::INT ELSE h END AS load_height,
       CASE WHEN least(w, h) > 0 THEN round(greatest(1024.0::DOUBLE / nullif(least(w, h), 0) * 72, 192) / 72, 9) END AS render_scale
FROM s
""")
def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of loaded images and scales of rendered pages."""
    sizes = _artifacts(spark, sf_dir).select(F.get("page_box", F.lit(2)).alias("width"), F.get("page_box", F.lit(3)).alias("height")).distinct()
    loaded = sizes.withColumn("s", geometry.upscaled_size(F.col("width"), F.col("height")))
    return loaded.select("width", "height", F.col("s.width").alias("load_width"), F.col("s.height").alias("load_height"), F.round(geometry.render_scale(F.col("width"), F.col("height")), 9).alias("render_scale"))


@_query("""
SELECT * FROM (VALUES ('h100', 80, 8192, 64), ('a100-80', 80, 8192, 64), ('a100', 40, 4096, 32), ('a100-40', 40, 4096, 32), ('l40s', 48, 4096, 32), ('a10', 24, 2048, 16),
  ('l4', 24, 2048, 16), ('4090', 24, 2048, 16), ('3090', 24, 2048, 16), ('t4', 16, 1024, 8)) AS t(gpu, memory, max_tokens, max_sequences)
""")
def gpu_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits of every known accelerator."""
    known = spark.createDataFrame([(g,) for g in serving.VRAM_GB], "gpu string").withColumn("memory", serving.vram(F.col("gpu")))
    return known.select("gpu", "memory", serving.batched_tokens(F.col("memory")).alias("max_tokens"), serving.sequences(F.col("memory")).alias("max_sequences"))


@_query("""
SELECT DISTINCT attempt, CASE WHEN attempt = 1 THEN 0.0 ELSE least(0.2 * (attempt - 1), 0.8) END::DOUBLE AS temperature, CASE WHEN attempt = 1 THEN 0.1 ELSE 0.95 END::DOUBLE AS top_p, 2 * attempt AS wait_seconds
FROM generation_results
""")
def retry_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature, top-p and wait of every attempt that occurs."""
    retries = F.col("attempt") - 1
    ladder = read_table(spark, sf_dir, "generation_results").select("attempt").distinct()
    return ladder.select("attempt", F.round(serving.retry_temperature(F.lit(0.0), retries), 9).alias("temperature"), serving.retry_top_p(retries).alias("top_p"), serving.backoff_seconds(retries).alias("wait_seconds"))


@_query("SELECT doc_id, 'data:image/png;base64,' || base64(encode(text)) AS url FROM documents WHERE text IS NOT NULL")
def data_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as if they were the bytes of images, as data URLs."""
    docs = read_table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.replace(text.data_url(F.encode("text", "UTF-8"), F.lit("PNG")), F.lit("\r\n"), F.lit("")).alias("url"))


@_query("""
SELECT doc_id, page_num, md5(list_reduce(list_prepend(markdown, list_transform(image_files, lambda f: f)), lambda text, f: replace(text, '(' || f || ')', '(data:' || page_num || ':' || f || ')'))) AS markdown_md5, count(*) AS n
FROM page_artifacts GROUP BY ALL
""")
def embedded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown of every page with the links of all its images replaced."""
    names = F.array_distinct(F.coalesce("image_files", F.array().cast("array<string>")))
    urls = F.map_from_arrays(names, F.transform(names, lambda f: F.concat(F.lit("data:"), F.col("page_num").cast("string"), F.lit(":"), f)))
    return _artifacts(spark, sf_dir).groupBy("doc_id", "page_num", F.md5(text.embed_images(F.col("markdown"), urls)).alias("markdown_md5")).agg(F.count("*").alias("n"))


@_query(r"""
SELECT doc_id, path, regexp_extract(path, '([^/]*)$', 1) AS file_name, lower(regexp_extract(path, '(\.[^./]+)$', 1)) AS suffix, count(*) AS n
FROM source_files WHERE lower(regexp_extract(path, '(\.[^./]+)$', 1)) IN ('.pdf', '.png', '.jpg', '.jpeg', '.gif', '.webp', '.tiff', '.bmp') GROUP BY ALL
""")
def supported_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files that are source documents."""
    from quirework.sources import files

    found = files.supported(read_table(spark, sf_dir, "source_files"))
    return found.groupBy("doc_id", "path", text.file_name(F.col("path")).alias("file_name"), text.suffix(F.col("path")).alias("suffix")).agg(F.count("*").alias("n"))


@_query("""
WITH b AS (SELECT doc_id, min(path) AS path FROM source_files GROUP BY doc_id)
SELECT doc_id, row_number() OVER (ORDER BY path, doc_id) AS book_no, count(*) OVER () AS n_books FROM b
""")
def book_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books in the order in which a run takes them."""
    return progress.book_numbers(read_table(spark, sf_dir, "source_files")).select("doc_id", "book_no", "n_books")


@_query(f"""
WITH {_ONE}, e AS (SELECT DISTINCT doc_id, unnest(expected_pages) AS page_num FROM run_state),
lacking AS (SELECT DISTINCT doc_id FROM e WHERE page_num IS NOT NULL AND NOT EXISTS (SELECT 1 FROM one WHERE one.doc_id = e.doc_id AND one.page_num = e.page_num))
SELECT e.doc_id, count(*) AS n_pages, count(*) FILTER (WHERE one.error) AS n_failed, sum(coalesce(one.token_count, 0))::BIGINT AS total_token_count
FROM e JOIN one ON one.doc_id = e.doc_id AND one.page_num = e.page_num WHERE e.doc_id NOT IN (SELECT doc_id FROM lacking) GROUP BY e.doc_id
""")
def stream_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a stream of their pages completes. The table is streamed file by file."""
    pages = assemble.one_per_page(_artifacts(spark, sf_dir), {"token_count": F.col("token_count"), "error": F.col("error")})
    base = scratch_folder(spark, "stream")
    pages.repartition(8).write.parquet(f"{base}/pages")
    resume.expected_pages(read_table(spark, sf_dir, "run_state")).write.parquet(f"{base}/expected")
    expected = spark.read.parquet(f"{base}/expected")
    stream = completion.read_artifacts(spark, f"{base}/pages", pages.schema, files_per_batch=4)
    completion.drain(completion.complete_parts(stream, expected), lambda batch, _: batch.write.mode("append").parquet(f"{base}/parts"), f"{base}/state")
    return completion.complete_documents(spark.read.schema(completion.PARTS_SCHEMA).parquet(f"{base}/parts"), expected)


@_query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type, by the streaming aggregation run over a table."""
    return completion.event_counts(read_table(spark, sf_dir, "events")).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call that became each page, with the page's size and the book's stem."""
    sizes = assemble.one_per_page(_artifacts(spark, sf_dir), {"width": F.get("page_box", F.lit(2)), "height": F.get("page_box", F.lit(3))})
    stems = read_table(spark, sf_dir, "source_files").groupBy("doc_id").agg(F.min("stem").alias("stem"))
    calls = model.accepted_calls(read_table(spark, sf_dir, "generation_results"))
    return calls.join(sizes, ["doc_id", "page_num"], "left").join(stems, "doc_id", "left")


def _letters(html: Column) -> Column:
    """Plain letters and digits of the text of HTML."""
    bare = F.regexp_replace(F.regexp_replace(html, "<[^<>]*>", " "), "&(amp;)*(#?[a-zA-Z0-9]+;)?", "")
    return F.regexp_replace(bare, "[^a-zA-Z0-9]", "")


_LETTERS = "regexp_replace(regexp_replace(regexp_replace({0}, '<[^<>]*>', ' ', 'g'), '&(amp;)*(#?[a-zA-Z0-9]+;)?', '', 'g'), '[^a-zA-Z0-9]', '', 'g')"
#: Elements whose contents never pass.
_PAYLOADS = "|".join(f"<{tag}[^<>]*>.*?(</{tag}>|$)" for tag in ("script", "style", "iframe", "object", "embed", "noscript")) + "|<!--.*?(-->|$)"
#: Raw output without payloads, what is cut inside a tag behind the last block, and headers, footers and blank blocks.
_BODY = (
    f"regexp_replace(regexp_replace(regexp_replace(coalesce(g.raw, ''), '{_PAYLOADS}', ' ', 'gis'), '(^|</div>)\\s*<[^<>]*$', '</div>'), "
    """'<div [^<>]*data-label="(Page-Header|Page-Footer|Blank-Page)"[^<>]*>.*?(</div>|$)', ' ', 'gs')"""
)
#: The call that became each page, with the blocks that its text names in order.
_BLOCKS = r"""
calls AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY attempt DESC, request_id DESC) AS k FROM generation_results),
good AS (SELECT doc_id, page_num, raw FROM calls WHERE k = 1 AND raw IS NOT NULL AND NOT coalesce(error, false)),
opened AS (SELECT doc_id, page_num, raw, regexp_extract_all(raw, '<div [^<>]*data-label="[^"]*"[^<>]*>') AS tags FROM good),
blocks AS (SELECT doc_id, page_num, i, regexp_extract(tags[i], 'data-label="([^"]*)"', 1) AS label, regexp_extract(tags[i], 'data-bbox="([^"]*)"', 1) AS box
  FROM (SELECT doc_id, page_num, tags, unnest(range(1, len(tags) + 1)) AS i FROM opened))
"""
_SIZES = "sizes AS (SELECT doc_id, page_num, coalesce(page_box[3], 1000) AS w, coalesce(page_box[4], 1000) AS h FROM one)"


@_query(f"""
WITH {_BLOCKS}, n AS (SELECT doc_id, page_num, count(*) FILTER (WHERE label <> 'Blank-Page') AS num_chunks FROM blocks GROUP BY ALL)
SELECT c.doc_id, c.page_num, coalesce(n.num_chunks, 0) AS num_chunks, g.raw IS NULL AS error,
  md5({_LETTERS.format(_BODY)}) AS letters_md5
FROM (SELECT doc_id, page_num FROM calls WHERE k = 1) c LEFT JOIN good g ON g.doc_id = c.doc_id AND g.page_num = c.page_num LEFT JOIN n ON n.doc_id = c.doc_id AND n.page_num = c.page_num
""")
def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts made from the recorded model output: number of chunks, errors, and the letters of the HTML without headers and footers."""
    made = parse.parse_pages(_raw_pages(spark, sf_dir))
    return made.select("doc_id", "page_num", F.size("chunks").alias("num_chunks"), "error", F.md5(_letters(F.col("html_filtered"))).alias("letters_md5"))


@_query(f"""
WITH {_ONE}, {_BLOCKS}, {_SIZES}, stems AS (SELECT doc_id, min(stem) AS stem FROM source_files GROUP BY doc_id),
shown AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY i) - 1 AS place, string_split(box, ' ') AS s FROM blocks WHERE label <> 'Blank-Page'),
b AS (SELECT *, CASE WHEN len(s) = 4 AND len(list_filter(s, lambda x: NOT regexp_full_match(x, '[+-]?[0-9]+'))) = 0 THEN list_transform(s, lambda x: x::INT) ELSE [0, 0, 1000, 1000] END AS q FROM shown)
SELECT b.doc_id, b.page_num, coalesce(nullif(b.label, ''), 'block') AS label,
  CASE WHEN t.stem IS NULL THEN '_/' ELSE coalesce(nullif(trim(regexp_replace(t.stem, '[^\\p{{L}}\\p{{N}}_-]+', '-', 'g'), '-'), ''), '_') || '/' || lpad(b.page_num::VARCHAR, 4, '0') || '/' END || lpad(place::VARCHAR, 3, '0') AS chunk_id,
  concat_ws(' ', greatest(0, trunc(q[1] * (coalesce(w, 1000) / 1000.0::DOUBLE)))::INT, greatest(0, trunc(q[2] * (coalesce(h, 1000) / 1000.0::DOUBLE)))::INT,
    least(trunc(q[3] * (coalesce(w, 1000) / 1000.0::DOUBLE)), coalesce(w, 1000))::INT, least(trunc(q[4] * (coalesce(h, 1000) / 1000.0::DOUBLE)), coalesce(h, 1000))::INT) AS bbox
FROM b LEFT JOIN sizes z ON z.doc_id = b.doc_id AND z.page_num = b.page_num LEFT JOIN stems t ON t.doc_id = b.doc_id
""")
def parsed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks made from the recorded model output: names, labels and boxes in pixels."""
    made = parse.parse_pages(_raw_pages(spark, sf_dir))
    chunks = made.select("doc_id", "page_num", F.explode("chunks").alias("c"))
    return chunks.select("doc_id", "page_num", "c.chunk_id", "c.label", F.array_join("c.bbox", " ").alias("bbox"))


@_query(f"""
SELECT DISTINCT doc_id, page_num, md5({_LETTERS.format(f"regexp_replace(raw_html, '{_PAYLOADS}', ' ', 'gis')")}) AS letters_md5, len(regexp_extract_all(raw_html, '<div( [^<>]*)?>')) AS n_divs, len(regexp_extract_all(raw_html, '<p( [^<>]*)?>')) AS n_paragraphs,
  len(regexp_extract_all(raw_html, '<t[dh]( [^<>]*)?>')) AS n_cells, len(regexp_extract_all(raw_html, '<img( [^<>]*)?/?>')) AS n_images, raw_html IS NULL AS missing
FROM page_artifacts
""")
def sanitized_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sanitized model output of every page: its letters and how many elements of some kinds it keeps."""
    clean = parse.sanitized(_artifacts(spark, sf_dir).select("doc_id", "page_num", "raw_html"), "raw_html")
    html = F.col("raw_html")
    counts = {"n_divs": "<div[ >]", "n_paragraphs": "<p[ >]", "n_cells": "<t[dh][ >]", "n_images": "<img[ />]"}
    return clean.select("doc_id", "page_num", F.md5(_letters(html)).alias("letters_md5"), *[F.regexp_count(html, F.lit(p)).alias(n) for n, p in counts.items()], html.isNull().alias("missing")).distinct()


@_query(f"""
WITH {_BLOCKS}
SELECT doc_id, page_num, string_agg(i, ',' ORDER BY i) AS image_blocks FROM blocks WHERE label IN ('Image', 'Figure') GROUP BY doc_id, page_num
""")
def parsed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the blocks that images are named after, counted from 1 with blank blocks, on every page that has some."""
    made = parse.parse_pages(_raw_pages(spark, sf_dir)).select("doc_id", "page_num", F.filter(F.transform("chunks", lambda c: c["image_name"]), lambda n: n.isNotNull()).alias("names"))
    return made.where(F.size("names") > 0).select("doc_id", "page_num", F.array_join(F.transform("names", lambda n: F.regexp_extract(n, r"_(\d+)_img\.webp$", 1)), ",").alias("image_blocks"))


@_query("""
WITH dirs AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, stem FROM source_files),
listed AS (SELECT DISTINCT path FROM source_files UNION SELECT dir || '/' || stem || '/copy.pdf' FROM dirs UNION SELECT dir || '/' || stem || '/deep/scan.png' FROM dirs UNION SELECT dir || '/beside/' || stem || '.tiff' FROM dirs)
SELECT path FROM listed WHERE lower(regexp_extract(path, '(\\.[^./]+)$', 1)) IN ('.pdf', '.png', '.jpg', '.jpeg', '.gif', '.webp', '.tiff', '.bmp')
  AND NOT EXISTS (SELECT 1 FROM dirs WHERE starts_with(listed.path, dirs.dir || '/' || dirs.stem || '/'))
""")
def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source documents among listed files, when every book has an output folder with copies in it beside other folders."""
    from quirework.sources import files

    sources = read_table(spark, sf_dir, "source_files")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    more = [F.concat(folder, F.lit("/"), F.col("stem"), F.lit("/"), name) for name in (F.concat("stem", F.lit(".md")), F.lit("copy.pdf"), F.lit("deep/scan.png"))]
    added = sources.select(F.explode(F.array(*more, F.concat(folder, F.lit("/beside/"), F.col("stem"), F.lit(".tiff")))).alias("path"))
    listed = sources.select("path").unionByName(added).distinct()
    return files.supported(files.outside(listed, files.output_folders(listed))).select("path")


@_query("""
SELECT DISTINCT page_num, lpad(page_num::VARCHAR, 4, '0') || '.json' AS name, true AS is_artifact, false AS unfinished_is FROM page_artifacts WHERE page_num IS NOT NULL
""")
def artifact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of page artifacts, told from those of unfinished writes."""
    named = _artifacts(spark, sf_dir).where("page_num is not null").select("page_num").distinct().withColumn("name", text.page_artifact_name(F.col("page_num")))
    return named.select("page_num", "name", text.is_page_artifact(F.col("name")).alias("is_artifact"), text.is_page_artifact(F.concat("name", F.lit(".tmp"))).alias("unfinished_is"))


@_query("SELECT doc_id, doc_id % 3 = 0 AS is_pdf FROM documents WHERE text IS NOT NULL")
def pdf_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which contents are PDFs, by their first bytes."""
    docs = read_table(spark, sf_dir, "documents").where("text is not null")
    content = F.encode(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("%PDF"), F.col("text"))).otherwise(F.concat(F.lit("x%PDF"), F.col("text"))), "UTF-8")
    return docs.select("doc_id", text.is_pdf(content).alias("is_pdf"))


@_query("""
SELECT DISTINCT doc_id, run_no, len(list_filter(expected_pages, lambda p: p >= 0 AND p < 20)) AS n_wanted, 20 AS n_all, array_to_string(list_filter(expected_pages, lambda p: p >= 0 AND p < 20), ' ') AS pages FROM run_state WHERE expected_pages IS NOT NULL
""")
def selected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested pages of documents of 20 pages that exist, and how many there are without a request."""
    states = read_table(spark, sf_dir, "run_state").where("expected_pages is not null")
    total, none = F.lit(20), F.lit(None).cast("array<int>")
    wanted = F.array_join(ranges.selected(F.col("expected_pages"), total), " ")
    return states.select("doc_id", "run_no", ranges.count_selected(F.col("expected_pages"), total).alias("n_wanted"), ranges.count_selected(none, total).alias("n_all"), wanted.alias("pages")).distinct()


@_query("""
SELECT DISTINCT upper(regexp_extract(path, '\\.([^./]+)$', 1)) AS format, CASE WHEN upper(regexp_extract(path, '\\.([^./]+)$', 1)) = 'JPEG' THEN 'image/jpeg' ELSE 'image/' || lower(regexp_extract(path, '\\.([^./]+)$', 1)) END AS mime
FROM source_files
""")
def mime_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MIME types of the formats that occur."""
    formats = read_table(spark, sf_dir, "source_files").select(F.upper(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("format")).distinct()
    return formats.select("format", text.mime_type(F.col("format")).alias("mime"))


@_query("""
WITH p AS (SELECT DISTINCT doc_id, page_num FROM page_artifacts WHERE page_num IS NOT NULL)
SELECT doc_id, page_num, '{"role":"user","content":[{"type":"image_url","image_url":{"url":"data:' || doc_id || '"}},{"type":"text","text":"'
  || CASE WHEN page_num % 5 = 0 THEN 'own ' || page_num WHEN page_num % 2 = 0 THEN 'read' ELSE 'lay out' END || '"}]}' AS message FROM p
""")
def request_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request about every page, with its own prompt or the one of its kind."""
    pages = _artifacts(spark, sf_dir).where("page_num is not null").select("doc_id", "page_num").distinct()
    own = F.when(F.col("page_num") % 5 == 0, F.concat(F.lit("own "), F.col("page_num").cast("string"))).when(F.col("page_num") % 3 == 0, "")
    kind = F.when(F.col("page_num") % 2 == 0, "ocr").otherwise("ocr_layout")
    asked = model.prompt(own, kind, {"ocr": "read", "ocr_layout": "lay out"})
    return pages.select("doc_id", "page_num", F.to_json(model.message(asked, F.concat(F.lit("data:"), F.col("doc_id")))).alias("message"))


class _Reader:
    """A model whose answers are known: it loops at first on some pages, and refuses others."""

    def generate(self, requests: pd.DataFrame, temperature: float, top_p: float) -> pd.DataFrame:
        rows = []
        for doc, page in zip(requests["doc_id"], requests["page_num"]):
            if page % 11 == 5:
                rows.append((None, 0, True, "auth"))
            elif page % 7 == 3 and temperature < 0.1 * (page % 4 + 1):
                rows.append(("again " * 60, 60, False, None))
            else:
                rows.append((f"{doc} {page}", len(doc), False, None))
        return pd.DataFrame(rows, columns=["raw", "token_count", "error", "error_kind"])


@_query("""
WITH p AS (SELECT DISTINCT doc_id, page_num FROM page_artifacts WHERE page_num IS NOT NULL)
SELECT doc_id, page_num, CASE WHEN page_num % 11 = 5 THEN '' ELSE doc_id || ' ' || page_num END AS raw, CASE WHEN page_num % 11 = 5 THEN 0 ELSE length(doc_id) END AS token_count, page_num % 11 = 5 AS error,
  CASE WHEN page_num % 11 = 5 THEN 'auth' END AS error_kind, CASE WHEN page_num % 11 <> 5 AND page_num % 7 = 3 THEN 1 + (page_num % 4 + 2) // 2 ELSE 1 END AS attempts
FROM p
""")
def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to every page after retries, each beside the page it belongs to."""
    pages = _artifacts(spark, sf_dir).where("page_num is not null").select("doc_id", "page_num").distinct()
    return model.generate(pages, _Reader)


@_query("""
WITH p AS (SELECT doc_id, page_num, max(finished_at) AS finished_at, bool_or(coalesce(error, false)) AS error FROM generation_results WHERE page_num IS NOT NULL GROUP BY doc_id, page_num),
b AS (SELECT doc_id, min(stem) AS stem, min(path) AS path FROM source_files GROUP BY doc_id), o AS (SELECT *, row_number() OVER (ORDER BY path, doc_id) AS book_no, count(*) OVER () AS n_books FROM b),
n AS (SELECT *, 3 + row_number() OVER (PARTITION BY doc_id ORDER BY finished_at NULLS FIRST, page_num) AS n_done, 3 + count(*) OVER (PARTITION BY doc_id) AS total FROM p)
SELECT n.doc_id, page_num, printf('  Book # %d of %d, %s, Page # %d of %d%s', book_no, n_books, stem, page_num + 1, total, CASE WHEN error THEN ' ERR' ELSE '' END) AS line
FROM n JOIN o ON o.doc_id = n.doc_id WHERE n_done % 4 = 0 OR n_done = total
""")
def progress_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that a run prints which goes on after three pages of each book were done, for every fourth page."""
    pages = read_table(spark, sf_dir, "generation_results").where("page_num is not null").groupBy("doc_id", "page_num").agg(F.max("finished_at").alias("finished_at"), F.bool_or(F.coalesce("error", F.lit(False))).alias("error"))
    totals = pages.groupBy("doc_id").agg((F.count("*") + 3).alias("total")).withColumn("already_done", F.lit(3))
    sources = read_table(spark, sf_dir, "source_files")
    books = progress.book_numbers(sources).join(sources.groupBy("doc_id").agg(F.min("stem").alias("stem")), "doc_id")
    return progress.lines(progress.page_progress(pages, totals, every=4).join(books.select("doc_id"), "doc_id"), books)


@_query(f"""
WITH {_ONE}, f AS (SELECT doc_id, min(regexp_extract(path, '([^/]*)$', 1)) AS file_name FROM source_files GROUP BY doc_id),
m AS (SELECT doc_id, page_num, page_box, coalesce(token_count, 0) AS token_count, coalesce(len(chunks), 0)::INT AS num_chunks, coalesce(len(image_files), 0)::INT AS num_images, error FROM one),
j AS (SELECT doc_id, count(*) AS num_pages, sum(token_count)::BIGINT AS total_token_count, sum(num_chunks)::BIGINT AS total_chunks, sum(num_images)::BIGINT AS total_images,
  list({{'page_num': page_num, 'page_box': page_box, 'token_count': token_count, 'num_chunks': num_chunks, 'num_images': num_images, 'error': error}} ORDER BY page_num) AS pages FROM m GROUP BY doc_id)
SELECT j.doc_id, to_json({{'file_name': file_name, 'num_pages': num_pages, 'total_token_count': total_token_count, 'total_chunks': total_chunks, 'total_images': total_images, 'pages': pages}})::VARCHAR AS metadata
FROM j LEFT JOIN f USING (doc_id)
""")
def metadata_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of every document as it is written to its file."""
    names = read_table(spark, sf_dir, "source_files").groupBy("doc_id").agg(F.min(text.file_name(F.col("path"))).alias("file_name"))
    return assemble.metadata_json(_artifacts(spark, sf_dir), names)


@_query(f"""
WITH {_ONE}, c AS (SELECT doc_id, page_num, unnest(chunks) AS k, generate_subscripts(chunks, 1) - 1 AS position FROM one)
SELECT doc_id, page_num, position, md5(to_json(k)::VARCHAR) AS line_md5 FROM c
""")
def chunk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the chunks' files: every chunk as JSON."""
    chunks = assemble.document_chunks(_artifacts(spark, sf_dir))
    fields = F.struct(*[c for c in chunks.columns if c not in ("doc_id", "page_num", "position")])
    return chunks.select("doc_id", "page_num", "position", F.md5(F.to_json(fields, {"ignoreNullFields": "false"})).alias("line_md5"))


@_query(f"""
WITH {_ONE}
SELECT doc_id, page_num, md5(to_json({{'image_base64': 'data:' || doc_id, 'image_width': page_box[3], 'image_height': page_box[4],
  'blocks': list_transform(chunks, lambda c: {{'bbox': c.bbox, 'label': c.label}}), 'html': html_filtered, 'markdown': markdown}})::VARCHAR) AS body_md5
FROM one WHERE page_box IS NOT NULL AND chunks IS NOT NULL AND html_filtered IS NOT NULL AND markdown IS NOT NULL
""")
def page_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer to a request about every page."""
    pages = assemble.one_per_page(_artifacts(spark, sf_dir)).where("page_box is not null and chunks is not null and html_filtered is not null and markdown is not null")
    shown = pages.select(
        "doc_id", "page_num", F.concat(F.lit("data:"), F.col("doc_id")).alias("image_url"), F.get("page_box", F.lit(2)).alias("width"), F.get("page_box", F.lit(3)).alias("height"),
        F.transform("chunks", lambda c: F.struct(c["bbox"].alias("bbox"), c["label"].alias("label"))).alias("blocks"), F.col("html_filtered").alias("html"), "markdown",
    )
    return outputs.response(shown, keep=("doc_id", "page_num")).select("doc_id", "page_num", F.md5("body").alias("body_md5"))


@_query("""
SELECT doc_id, page_num, sum(len(list_filter(regexp_extract_all(html_filtered, '<img[^<>]*src="([^"]*)"', 1), lambda s: list_contains(image_files, s))))::BIGINT AS n_data_urls FROM page_artifacts WHERE html_filtered IS NOT NULL GROUP BY doc_id, page_num
""")
def inlined_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many images of each page are replaced by data URLs."""
    pages = _artifacts(spark, sf_dir).where("html_filtered is not null")
    names = F.array_distinct(F.coalesce("image_files", F.array().cast("array<string>")))
    urls = F.map_from_arrays(names, F.transform(names, lambda f: F.concat(F.lit("data:"), f)))
    made = parse.with_inline_images(pages.select("doc_id", "page_num", "html_filtered", urls.alias("urls")), "html_filtered", "urls")
    return made.groupBy("doc_id", "page_num").agg(F.sum(F.regexp_count("html_filtered", F.lit('src="data:'))).alias("n_data_urls"))


@_query(f"""
WITH firsts AS (
  SELECT doc_id, text, list_position(list_transform(string_split(text, chr(10)), lambda x: regexp_matches(x, '^#[ \\t]+\\S')), true) AS s FROM documents),
rest AS (SELECT doc_id, array_to_string(string_split(text, chr(10))[s:], chr(10)) AS text FROM firsts WHERE s > 0), {_HEADINGS_OF.replace("SOURCE", "rest")},
t AS (SELECT doc_id, min(level) AS top FROM anchored GROUP BY doc_id),
made AS (
  SELECT doc_id, '# Table of Contents' || chr(10) || chr(10) || string_agg(repeat('  ', (level - top)::INT) || '- [' || heading || '](#' || CASE WHEN k = 0 THEN base ELSE base || '-' || k END || ')', chr(10) ORDER BY n) || chr(10) || chr(10) AS toc
  FROM anchored JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, md5(coalesce(toc, '# Table of Contents' || chr(10) || chr(10) || '_(no headings found)_' || chr(10)) || text) AS rewritten_md5 FROM rest LEFT JOIN made USING (doc_id)
""")
def toc_rewrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, each behind a printed table of contents, with that table replaced by one of their headings."""
    printed = F.concat(F.lit("# Table of Contents\n## 1\nIndex 7\n"), F.col("text"))
    return toc.rewrite(read_table(spark, sf_dir, "documents").select("doc_id", printed.alias("text"))).select("doc_id", F.md5("rewritten").alias("rewritten_md5"))


@_query(r"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY attempt DESC, request_id DESC) AS k FROM generation_results),
l AS (SELECT doc_id, page_num, list_filter(regexp_extract_all(raw, '<div (?:data-bbox="[^"]*" )?data-label="([^"]*)"[^>]*>', 1), lambda x: x <> 'Blank-Page') AS labels FROM r WHERE k = 1 AND raw IS NOT NULL AND NOT coalesce(error, false))
SELECT doc_id, page_num, array_to_string(labels, ',') AS labels, len(labels) AS n_blocks FROM l
""")
def parsed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the blocks that parsing finds on every page, in order."""
    made = parse.parse_pages(_raw_pages(spark, sf_dir)).where("not error")
    return made.select("doc_id", "page_num", F.array_join(F.transform("chunks", lambda c: c["label"]), ",").alias("labels"), F.size("chunks").alias("n_blocks"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
