"""The registered queries: one per operator, over its whole table, and the SQL that expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversation_repair,
    exact_dedup,
    hard_negatives,
    html_text,
    language,
    line_dedup,
    mixing,
    piece_bpe,
    quality,
    simhash,
    toxicity,
    url_filter,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy of it that stays."""
    found = exact_dedup.exact_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines, those that another document keeps, and what is left."""
    return line_dedup.line_duplicates(_read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the component of near copies that it belongs to."""
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def _draw(value: Column, salt: str) -> Column:
    """A number from 0 to 2^28 - 1 that any engine can derive from the value."""
    return F.conv(F.substring(F.md5(F.concat(value, F.lit(salt))), 1, 7), 16, 10).cast("int")


def dated_entries(pages: DataFrame) -> DataFrame:
    """A list history of the pages' own hosts, domains and sections: (list, target, day, added).

    Every target comes on a list; half of them leave it again, and a third of those return.
    """
    found = pages.select(F.explode(url_filter.targets_of(F.col("url"))).alias("target")).distinct()
    listed = found.where(F.size(F.split("target", "/")) <= 2).where(_draw(F.col("target"), "chosen") % 3 == 0)
    names = F.array(*[F.lit(n) for n in ("adult", "malware", "spam")])
    came = listed.select(
        names[_draw(F.col("target"), "list") % 3].alias("list"), "target",
        F.date_add(F.lit("2024-01-01").cast("date"), _draw(F.col("target"), "day") % 200).alias("day"),
        (_draw(F.col("target"), "left") % 6).alias("fate"),
    )
    left = came.where("fate < 3").withColumn("day", F.date_add("day", 60))
    back = came.where("fate < 1").withColumn("day", F.date_add("day", 90))
    events = [df.select("list", "target", "day", F.lit(added).alias("added")) for df, added in ((came, True), (left, False), (back, True))]
    return events[0].unionByName(events[1]).unionByName(events[2])


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched on some day of a year, against the list entries valid on that day."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), _draw(F.col("page_id").cast("string"), "fetched") % 366)
    judged = url_filter.filtered(pages.withColumn("fetched", day), dated_entries(pages))
    return judged.withColumns({"fetched": F.col("fetched").cast("string"), "lists": F.array_join("lists", ",")})


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity, learned from labelled documents that are not held out."""
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_text.main_texts(_read(spark, sf_dir, "pages"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from documents that are not held out."""
    return language.languages(_read(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and the digests of its ids and of what they decode to."""
    return bpe.round_trip(_read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its rule statistics and the forest's verdict."""
    return quality.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece count and the digests of its ids and of what they decode to."""
    return piece_bpe.round_trip(_read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults and the cheapest repair of its turns."""
    return conversation_repair.damaged_and_repaired(_read(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector, the rows of other labels that score high beside its best own ones; some labels are moved first."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(_read(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash": op3_simhash,
    "op4_url_filter": op4_url_filter,
    "op5_toxicity": op5_toxicity,
    "op6_html_text": op6_html_text,
    "op7_language": op7_language,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_mix": op10_mix,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

# A-Z lower-cased only: translate() in both engines
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY t)
    """,
    "op2_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
                   FROM documents),
        l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                  '{_UPPER}', '{_LOWER}') AS key FROM l),
        shared AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40
                   GROUP BY key HAVING count(DISTINCT r) >= 5),
        m AS (SELECT k.*, coalesce(doc_id <> owner, false) AS gone FROM k LEFT JOIN shared USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY r, doc_id
    """,
    "op4_url_filter": r"""
        WITH parsed AS (
            SELECT row_number() OVER () AS r, page_id, url, DATE '2024-01-01' + CAST(
                       CAST('0x' || left(md5(CAST(page_id AS VARCHAR) || 'fetched'), 7) AS INT) % 366 AS INT) AS fetched,
                   rtrim(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
                   list_filter(string_split(regexp_extract(coalesce(url, ''),
                       '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segments
            FROM pages),
        captures AS (SELECT *, array_to_string(list_prepend(host, segments), '/') || '/' AS full_path
                     FROM parsed),
        hosts AS (SELECT DISTINCT host FROM captures WHERE host <> ''),
        targets AS (
            SELECT DISTINCT host || '/' || segments[1] AS target FROM captures WHERE host <> '' AND len(segments) > 0
            UNION SELECT array_to_string(list_slice(string_split(host, '.'), i, 30), '.')
            FROM hosts, range(1, 30) AS g(i) WHERE i <= len(string_split(host, '.'))),
        drawn AS (SELECT target, CAST('0x' || left(md5(target || 'list'), 7) AS INT) % 3 AS name,
                         CAST('0x' || left(md5(target || 'day'), 7) AS INT) % 200 AS came,
                         CAST('0x' || left(md5(target || 'left'), 7) AS INT) % 6 AS fate
                  FROM targets WHERE CAST('0x' || left(md5(target || 'chosen'), 7) AS INT) % 3 = 0),
        spans AS (
            SELECT target, name, came AS first_day, CASE WHEN fate < 3 THEN came + 60 ELSE 100000 END AS last_day FROM drawn
            UNION ALL SELECT target, name, came + 90, 100000 FROM drawn WHERE fate < 1),
        hits AS (
            SELECT c.r, s.target, ['adult', 'malware', 'spam'][s.name + 1] AS list
            FROM captures c JOIN spans s
              ON (s.target = c.host OR suffix(c.host, '.' || s.target)
                  OR (contains(s.target, '/') AND starts_with(c.full_path, s.target || '/')))
             AND date_diff('day', DATE '2024-01-01', c.fetched) >= s.first_day
             AND date_diff('day', DATE '2024-01-01', c.fetched) < s.last_day
            WHERE c.host <> ''),
        judged AS (SELECT r, count(*) AS n_entries, arg_max(target, length(target)) AS target,
                          array_to_string(list_sort(list_distinct(list(list))), ',') AS lists
                   FROM hits GROUP BY r)
        SELECT page_id, url, strftime(fetched, '%Y-%m-%d') AS fetched, n_entries IS NOT NULL AS blocked,
               coalesce(n_entries, 0) AS n_entries, target, coalesce(lists, '') AS lists
        FROM captures LEFT JOIN judged USING (r)
    """,
    # crc32 bit by bit, then a search row by row: of each state of the pattern the best (cost, audit)
    "op12_conversation_repair": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
                       list_prepend(4294967295, list_transform(
                           string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                           lambda c: CAST(ascii(c) AS BIGINT))),
                       lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                           lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 20 AS kind
            FROM conversations),
        faulty AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM keyed, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
        -- repeated rows get their places before it is told which of them is the first
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM faulty),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
            FROM ranked),
        read AS (
            SELECT *, left(role, 1) AS initial, said = '' AS blank, said <> '' AND nth > 1 AS duplicate,
                   said <> '' AND nth = 1 AND right(said, 1) NOT IN ('.', '!', '?') AS truncated,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
            FROM placed),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
            FROM read GROUP BY conv_id),
        gap(q, g, price, audit, lines) AS (VALUES
            (0, 0, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
            (1, 1, 0, '', ''), (1, 2, 3, 'I', chr(10) || 'user:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
            (2, 2, 0, '', ''), (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 3, 0, '', ''), (3, 2, 3, 'I', chr(10) || 'user:')),
        move(g, initial, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        edit AS (
            SELECT conv_id, pos, m.g, m.q, CASE WHEN truncated THEN 3 ELSE 0 END AS price, 'K' AS audit,
                   chr(10) || role || ':' || text AS lines
            FROM read JOIN move m USING (initial) WHERE NOT blank AND NOT duplicate
            UNION ALL
            SELECT conv_id, pos, m.g, m.q, CASE WHEN truncated THEN 6 ELSE 3 END, 'R',
                   chr(10) || CASE m.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
            FROM read, move m WHERE NOT blank AND NOT duplicate AND m.initial IN ('u', 'a') AND m.initial <> read.initial
            UNION ALL
            SELECT conv_id, pos, g, g, 4, 'D', '' FROM read, range(4) AS states(g)),
        step(conv_id, pos, q, found) AS (
            SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': '', 'lines': ''} FROM counted
            UNION ALL
            SELECT s.conv_id, s.pos + 1, CAST(e.q AS INT), min({
                'cost': s.found.cost + gap.price + e.price, 'audit': s.found.audit || gap.audit || e.audit,
                'lines': s.found.lines || gap.lines || e.lines})
            FROM step s JOIN gap ON gap.q = s.q
            JOIN edit e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.pos = s.pos + 1 AND e.g = gap.g
            GROUP BY ALL),
        best AS (
            SELECT s.conv_id, min({
                'cost': s.found.cost + gap.price, 'audit': s.found.audit || gap.audit, 'lines': s.found.lines || gap.lines}) AS found
            FROM step s JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.pos
            JOIN gap ON gap.q = s.q AND gap.g IN (0, 3) GROUP BY s.conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               CAST(coalesce(b.found.cost, 0) AS BIGINT) AS cost, coalesce(b.found.audit, '') AS audit,
               sha256(coalesce(b.found.lines[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS own,
                   CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
        positive AS (
            SELECT * FROM scored WHERE own
            QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, b) <= 5),
        negative AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id NULLS LAST, n.b) AS rank
            FROM positive p JOIN scored n ON n.a = p.a AND NOT n.own
             AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
        FROM negative WHERE rank <= 10
    """,
}
