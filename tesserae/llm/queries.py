"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import conversations, langid, linededup, lm, mixing, neardup_vectors, packing, quality, sharding, simhash, spelling, tokens, toxicity
from tesserae.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.scored(docs, *lm.fit(docs))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measured(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).drop("source")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.linked(table(spark, sf_dir, "embeddings"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damaged(rows), rows)


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predicted(docs, langid.fit(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_lm": op5_lm,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_embeddings": op10_embeddings,
    "op11_spelling": op11_spelling,
    "op12_conversations": op12_conversations,
    "op13_language": op13_language,
}

def _quality_sql(r: quality.Rules) -> str:
    """The rules in SQL: windows of n words by their concatenation, and who lies inside one found again."""

    def cover(n: int) -> str:
        text = f"concat_ws(' ', {', '.join(['w'] + [f'lead(w, {k}) OVER o' for k in range(1, n)])})"
        return f"""SELECT doc_id, sum(len_) AS chars, count(*) AS words FROM (
      SELECT doc_id, len_, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside FROM (
        SELECT doc_id, i, len_, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS again FROM (
          SELECT doc_id, i, length(w) AS len_, CASE WHEN lead(w, {n - 1}) OVER o IS NOT NULL THEN {text} END AS g FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)) a) b) c WHERE inside GROUP BY doc_id"""

    word, ngrams = mixing.WORD, r.ngrams
    failed = f"(n_words < {r.least_words} OR 100 * n_repeat_words > {r.most_repeated_words_percent} * n_words)"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
l AS (SELECT doc_id, count(*) AS lines, count(*) - count(DISTINCT line) AS again, coalesce(sum(chars) FILTER (k > 1), 0) AS again_chars FROM (
  SELECT doc_id, line, len(array_to_string(regexp_extract_all(line, '{word}'), '')) AS chars, row_number() OVER (PARTITION BY doc_id, line ORDER BY j) AS k
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS j FROM d) x WHERE regexp_matches(line, '{word}')) y GROUP BY doc_id),
s AS (SELECT doc_id, count_if(w = p) AS same FROM (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w) x GROUP BY doc_id),
{", ".join(f"c{n} AS ({cover(n)})" for n in ngrams)},
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  coalesce(l.again, 0)::BIGINT AS n_dup_lines, coalesce(c5.words, 0)::BIGINT AS n_repeat_words, coalesce(lines, 0) AS lines, coalesce(again_chars, 0) AS again_chars, coalesce(same, 0) AS same,
  {", ".join(f"coalesce(c{n}.chars, 0) AS k{n}" for n in ngrams)}
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id {" ".join(f"LEFT JOIN c{n} ON c{n}.doc_id = d.doc_id" for n in ngrams)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,
  NOT {failed} AND n_dup_lines <= greatest({r.few}, {r.lines}::DOUBLE * lines) AND again_chars <= {r.line_chars}::DOUBLE * word_chars
  AND n_symbols <= {r.symbols}::DOUBLE * n_words AND same <= {r.stutter}::DOUBLE * n_words AND {" AND ".join(f"k{n} <= {x}::DOUBLE * word_chars" for n, x in ngrams.items())} AS kept
FROM m"""


#: CRC-32 from its polynomial, byte by byte.
CRC_TABLE = "(SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) t(i)) x)"
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(t))), lambda j: ('0x' || substr(hex_, 2 * j + 1, 2))::BIGINT)),
  lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"""


_CONVERSATIONS_SQL = rf"""
WITH RECURSIVE hex AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body, t, hex(encode(t)) AS hex_
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS t FROM conversations) x),
src AS (SELECT conv_id, turn, role, body, {CRC} % 20 AS c FROM hex, {CRC_TABLE} y),
dmg AS (SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role, CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body,
  unnest(range(CASE c WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(body)) AS i FROM dmg),
pre AS (SELECT *, substr(role, 1, 1) AS k, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before, NOT regexp_matches(body, '{mixing.WORD}') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, body ORDER BY i) > 1 AS again, NOT regexp_matches(body, '[.!?][\x20\x09-\x0D]*$') AS open_ FROM num),
f AS (SELECT *, again AND NOT blank AS dup, open_ AND NOT blank AND NOT again AS cut FROM pre),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(dup) AS duplicate, count_if(cut) AS truncated,
  count_if(i > 1 AND before || k NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
dp(conv_id, i, s0, ss, su, sa) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': ''}}, {{'c': 1000000000::BIGINT, 'a': ''}}, {{'c': 2::BIGINT, 'a': 'I'}}, {{'c': 4::BIGINT, 'a': 'II'}} FROM counts
  UNION ALL
  SELECT conv_id, i, s0, ss, u2, list_sort([a1, {{'c': u2.c + 2, 'a': u2.a || 'I'}}])[1] FROM (
    SELECT *, list_sort([u1, {{'c': s0.c + 2, 'a': s0.a || 'I'}}, {{'c': ss.c + 2, 'a': ss.a || 'I'}}, {{'c': a1.c + 2, 'a': a1.a || 'I'}}])[1] AS u2 FROM (
      SELECT d.conv_id, f.i, {{'c': s0.c + 3, 'a': s0.a || 'D'}} AS s0,
        list_sort([{{'c': ss.c + 3, 'a': ss.a || 'D'}}, CASE WHEN NOT (blank OR dup) AND k = 's' THEN {{'c': s0.c + cut::INT, 'a': s0.a || 'K'}} ELSE {{'c': 1000000000::BIGINT, 'a': ''}} END])[1] AS ss,
        list_sort(list_concat([{{'c': su.c + 3, 'a': su.a || 'D'}}], CASE WHEN blank OR dup THEN [] ELSE list_transform([s0, ss, sa], lambda x: {{'c': x.c + cut::INT + CASE WHEN k = 'u' THEN 0 ELSE 2 END, 'a': x.a || CASE WHEN k = 'u' THEN 'K' ELSE 'R' END}}) END))[1] AS u1,
        list_sort(list_concat([{{'c': sa.c + 3, 'a': sa.a || 'D'}}], CASE WHEN blank OR dup THEN [] ELSE [{{'c': su.c + cut::INT + CASE WHEN k = 'a' THEN 0 ELSE 2 END, 'a': su.a || CASE WHEN k = 'a' THEN 'K' ELSE 'R' END}}] END))[1] AS a1
      FROM dp d JOIN f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1) x) y),
best AS (SELECT d.conv_id, list_sort([s0, sa])[1] AS b FROM dp d JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.n = d.i),
letters AS (SELECT conv_id, unnest(string_split(b.a, '')) AS e, generate_subscripts(string_split(b.a, ''), 1) AS p FROM best WHERE b.a <> ''),
placed AS (SELECT *, count_if(e <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM letters),
made AS (SELECT p.conv_id, p, e, coalesce(f.role, '') AS role, coalesce(f.body, '') AS body, e <> 'D' AND NOT (e = 'K' AND f.k = 's') AS talks
  FROM placed p LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i AND p.e <> 'I'),
told AS (SELECT *, count_if(talks) OVER (PARTITION BY conv_id ORDER BY p) AS o FROM made),
out AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN o % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE body END, chr(10) ORDER BY p)) AS h
  FROM told WHERE e <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN out h ON h.conv_id IS NOT DISTINCT FROM o.conv_id"""

_SPELLING_SQL = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
k AS (SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS t FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
h AS (SELECT run, n, {CRC} AS h FROM (SELECT *, hex(encode(t)) AS hex_ FROM k) x, {CRC_TABLE} y),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM h) x
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT DISTINCT word, n, unnest(list_append(list_transform(range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1)), word)) AS key FROM w),
p AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.key = b.key AND a.word <> b.word
  WHERE abs(length(a.word) - length(b.word)) = 1 AND (a.key = a.word OR b.key = b.word)
    OR length(a.word) = length(b.word) AND len(list_filter(range(1, length(a.word) + 1), lambda i: substr(a.word, i, 1) <> substr(b.word, i, 1))) = 1),
m AS (SELECT word, n, count(*) AS n_near, max(other_n) AS most FROM p GROUP BY ALL),
o AS (SELECT m.word, n_near, most, min(other) AS other FROM m JOIN p ON p.word = m.word AND p.other_n = m.most GROUP BY ALL),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN other END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n FROM w LEFT JOIN o ON o.word = w.word),
r(word, reached, depth) AS (SELECT word, word, 0 FROM f UNION ALL SELECT r.word, f.form, depth + 1 FROM r JOIN f ON f.word = r.reached WHERE f.form IS NOT NULL),
e AS (SELECT word, max_by(reached, depth) AS root FROM r GROUP BY word)
SELECT f.word, form, root, n, n_near::BIGINT AS n_near, form_n FROM f JOIN e ON e.word = f.word"""

ORACLES: dict[str, str] = {
    "op2_mixing": r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '~') || '|' || coalesce(source, '~') || '|' || coalesce(md5(text), '~')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT none, key, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
n AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY none, key) - 1) % 3 + 1)::INT] AS w,
      row_number() OVER (ORDER BY none, key) AS i, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / w AS ratio, row_number() OVER (ORDER BY cap / w, i) AS k,
      ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n),
f AS (SELECT *, min(CASE WHEN level < ratio THEN k END) OVER () AS first_open FROM l),
t AS (SELECT none, key, source_size, CASE WHEN first_open IS NULL OR k < first_open THEN cap
      ELSE w * min(CASE WHEN k = first_open THEN level END) OVER () END AS target FROM f),
p AS (SELECT d.*, source_size, target, round(target)::BIGINT AS budget,
      coalesce(sum(size) OVER (PARTITION BY none, key ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t USING (none, key))
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN budget // source_size * size
     + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM p
""",
    "op10_embeddings": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (
  SELECT a.vec_id AS s, b.vec_id AS t FROM v a JOIN v b
  ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r(s, t) AS (SELECT s, t FROM e UNION SELECT r.s, e.t FROM r JOIN e ON r.t = e.s),
c AS (SELECT s, min(t) AS least FROM r GROUP BY s),
n AS (SELECT s, count(*) AS n FROM e GROUP BY s)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(c.least, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON c.s = vec_id LEFT JOIN n ON n.s = vec_id
""",
    "op6_quality": _quality_sql(quality.RULES),
    "op11_spelling": _SPELLING_SQL,
    "op12_conversations": _CONVERSATIONS_SQL,
    "op8_sharding": f"""
WITH d AS (SELECT doc_id, source, octet_length(encode(t)) + 1 AS size, {CRC} AS crc
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS hex_ FROM documents) x, {CRC_TABLE} y),
h AS (SELECT *, source IS NULL AS none, coalesce(source, '') AS key, ('0x' || substr(md5('11|' || coalesce(doc_id::VARCHAR, '~') || '|' || crc), 1, 15))::BIGINT AS h FROM d),
f AS (SELECT *, (row_number() OVER (PARTITION BY none, key ORDER BY h, doc_id NULLS FIRST, size, crc) - 1 + ('0x' || substr(md5('11|' || CASE WHEN none THEN '~' ELSE '=' || key END), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE) / count(*) OVER (PARTITION BY none, key) AS f FROM h),
p AS (SELECT *, row_number() OVER (ORDER BY f, none, key, h, doc_id NULLS FIRST, size, crc) - 1 AS place, count(*) OVER () AS n FROM f)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (place * 8 // n)::INT AS shard, (place - ((place * 8 // n) * n + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard FROM p
""",
}
