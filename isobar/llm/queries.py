"""Registered queries of the training-data operators, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isobar.llm import (classifier, decontam, licenses, linededup, lm, merkle, mixing, neardup, packing, repair, rules,
                        sharding, substrings)
from isobar.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


@query("op6_slot_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op4_decontaminate", rf"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
      SELECT item_id, w, least(10, len(w)) AS k FROM (
        SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
      WHERE len(w) > 0),
    bw AS (
      SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
      FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
    dw AS (
      SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b))),
    hits AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, s)),
    covered AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
    found AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op8_line_dedup", """
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents),
    keyed AS (
      SELECT doc_id, pos, line,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM lines),
    frequent AS (
      SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40
      GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
    SELECT doc_id, count(*) AS n_lines,
           count(*) FILTER (f.k IS NOT NULL AND f.top <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.k IS NULL OR f.top = doc_id), '')) AS kept_sha256
    FROM keyed LEFT JOIN frequent f USING (k) GROUP BY doc_id""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_lines(table(spark, sf_dir, "documents"))


@query("op9_substring_dedup", r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
      SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
    first AS (SELECT s, min(doc_id) AS top FROM windows GROUP BY s),
    gone AS (
      SELECT DISTINCT doc_id, p FROM (
        SELECT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first USING (s) WHERE top < doc_id)),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    kept AS (
      SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS t
      FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query("op3_near_duplicates", rf"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
    met AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM met JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.size + q.size - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
      SELECT doc_id, doc_id AS r FROM d
      UNION
      SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a)
    SELECT d.doc_id, coalesce(any_value(size), 0) AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
    FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_hmm_score")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


#: CRC-32 of an ASCII string ``{0}`` by bytes, over the table ``crc.t`` of the 256 remainders.
_CRC_TABLE = """crc AS (
      SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::UBIGINT, range(8)::UBIGINT[]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::UBIGINT)"
    return f"""xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {codes}),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])))"""


def _leaf(text: str) -> str:
    shown = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(shown)})"


# A tree is a list per level; a row's siblings are what its run of 16 holds besides it.
@query("op13_merkle_manifest", f"""
    WITH RECURSIVE {_CRC_TABLE},
    leaves AS (
      SELECT doc_id, source, {_leaf("text")} AS leaf,
        CASE WHEN {_crc("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS forged
      FROM documents, crc),
    placed AS (
      SELECT doc_id, source, leaf, coalesce(forged, leaf) AS shown,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
    levels AS (
      SELECT source, 0 AS level, list(leaf ORDER BY pos) AS h FROM placed GROUP BY source
      UNION ALL
      SELECT source, level + 1, list_transform(range(0, len(h), 16), lambda i: sha256(array_to_string(h[i + 1:i + 16], '')))
      FROM levels WHERE len(h) > 1),
    subroots AS (
      SELECT source, h[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM levels WHERE len(h) = 1),
    tops AS (
      SELECT 0 AS level, list(subroot ORDER BY place) AS h FROM subroots
      UNION ALL
      SELECT level + 1, list_transform(range(0, len(h), 16), lambda i: sha256(array_to_string(h[i + 1:i + 16], '')))
      FROM tops WHERE len(h) > 1),
    steps AS (
      SELECT p.doc_id, p.source, p.leaf, p.shown, p.pos, l.level, p.pos // (16 ** l.level)::BIGINT AS i, l.h
      FROM placed p JOIN levels l ON p.source IS NOT DISTINCT FROM l.source WHERE len(l.h) > 1
      UNION ALL
      SELECT p.doc_id, p.source, p.leaf, p.shown, p.pos, 100 + t.level, s.place // (16 ** t.level)::BIGINT, t.h
      FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source, tops t WHERE len(t.h) > 1),
    sides AS (
      SELECT source, pos, list([array_to_string(h[i // 16 * 16 + 1:i], ''), array_to_string(h[i + 2:i // 16 * 16 + 16], '')] ORDER BY level) AS s
      FROM steps GROUP BY source, pos),
    folded AS (
      SELECT p.source, p.pos, s.s, list_reduce(list_prepend([p.shown], coalesce(s.s, [])),
        lambda x, y: [sha256(y[1] || x[1] || y[2])])[1] AS folded_root
      FROM placed p LEFT JOIN sides s ON p.source IS NOT DISTINCT FROM s.source AND p.pos = s.pos)
    SELECT p.doc_id, p.leaf, b.subroot, t.h[1] AS root,
      sha256(array_to_string(list_transform(coalesce(f.s, []), lambda x: x[1] || x[2]), '')) AS proof_sha256,
      f.folded_root, f.folded_root = t.h[1] AS verified
    FROM placed p JOIN folded f ON p.source IS NOT DISTINCT FROM f.source AND p.pos = f.pos
      JOIN subroots b ON p.source IS NOT DISTINCT FROM b.source, tops t WHERE len(t.h) = 1""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


@query("op12_pack_sequences")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


# All edits of a conversation, row by row: per state the cheapest, then ASCII-least, edits so far.
@query("op11_conversation_repair", rf"""
    WITH RECURSIVE {_CRC_TABLE},
    c AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations, crc),
    d AS (
      SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN h = 0 THEN 0 WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM c),
    o AS (
      SELECT *, left(role, 1) AS init, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
    f AS (
      SELECT *, lag(init) OVER (PARTITION BY conv_id ORDER BY i) AS before,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
          WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
    k AS (
      SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || init NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
    ins(p, r, cost, edits, made) AS (VALUES
      ('', '', 0, '', ''), ('', 'u', 3, 'I', 'user:' || chr(10)), ('', 'a', 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
      ('s', 's', 0, '', ''), ('s', 'u', 3, 'I', 'user:' || chr(10)), ('s', 'a', 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
      ('u', 'u', 0, '', ''), ('u', 'a', 3, 'I', 'assistant:' || chr(10)), ('a', 'a', 0, '', ''), ('a', 'u', 3, 'I', 'user:' || chr(10))),
    walk AS (
      SELECT DISTINCT conv_id, 0 AS i, '' AS s, 0 AS cost, '' AS audit, '' AS lines FROM conversations
      UNION ALL
      SELECT conv_id, i, q, cost, audit, lines FROM (
        SELECT w.conv_id, f.i, w.audit || ins.edits || e AS audit,
          CASE e WHEN 'D' THEN r WHEN 'K' THEN init WHEN 'R' THEN CASE r WHEN 'u' THEN 'a' ELSE 'u' END END AS q,
          w.cost + ins.cost + CASE e WHEN 'D' THEN 4 ELSE CASE e WHEN 'R' THEN 3 ELSE 0 END + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END END AS cost,
          w.lines || made || CASE e WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || chr(10)
            ELSE CASE r WHEN 'u' THEN 'assistant' ELSE 'user' END || ':' || text || chr(10) END AS lines
        FROM walk w JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1 JOIN ins ON ins.p = w.s,
          (VALUES ('D'), ('K'), ('R')) x(e)
        WHERE e = 'D' OR fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR r || '>' || init IN ('>s', '>u', 's>u', 'u>a', 'a>u')))
      QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
    ended AS (
      SELECT w.conv_id, w.cost + ins.cost AS cost, audit || edits AS audit, lines || made AS lines
      FROM walk w LEFT JOIN k ON w.conv_id IS NOT DISTINCT FROM k.conv_id JOIN ins ON ins.p = w.s
      WHERE w.i = coalesce(n, 0) AND r IN ('', 'a')
      QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + ins.cost, audit || edits) = 1)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.cost::BIGINT AS cost, e.audit,
      sha256(left(lines, greatest(length(lines) - 1, 0))) AS repaired_sha256
    FROM ended e LEFT JOIN k ON e.conv_id IS NOT DISTINCT FROM k.conv_id""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit(table(spark, sf_dir, "conversations"))
