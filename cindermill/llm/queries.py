"""The operators applied with production parameters to the tables that they are meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.llm import ann, bpe, conversations, html_template, langid, media, ordered_packing, packing, quality, simhash, toxicity, variants, warc
from cindermill.llm.common import id_remainder, table

JSON_TOKENIZER = "byte_bpe_50k.json"
RANK_TOKENIZER = "byte_bpe_50k.tiktoken"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "lang", "text"), model)
    return toxicity.decide(scored, model).select("doc_id", "held_out", "score", "predicted", "threshold", "flagged")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(JSON_TOKENIZER), public_tokenizers.PATTERN, added_tokens=True)


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.main_text(table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.judge(table(spark, sf_dir, "documents"), trusted)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", lambda vec_id: vec_id % 100 == 0)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, bpe.read_ranks(public_tokenizers.path(RANK_TOKENIZER)), public_tokenizers.PATTERN)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 4) == 2
    filters = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), filters)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordered_packing.pack_in_order(docs, public_tokenizers.path(JSON_TOKENIZER), public_tokenizers.PATTERN)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repaired_conversations(rows, conversations.damage(rows))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), modulus=199)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_best_fit_packing, op3_media_columns, op4_html_extraction, op5_warc, op6_quality_classifier, op7_nearest_neighbours, op8_byte_bpe, op9_language_id, op10_simhash, op11_ordered_packing, op12_conversation_repair, op13_spelling_variants)}

#: base32 of the SHA-1 in SQL: 160 bits from the hex digits, five at a time.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, octet_length(encode(body)) AS n, sha1(body) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', substr(hex, i, 1))]), '') AS bits FROM h),
d AS (SELECT page_id, n, hex, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * (substr(bits, 5 * j + 1, 1) = '1')::INT + 8 * (substr(bits, 5 * j + 2, 1) = '1')::INT + 4 * (substr(bits, 5 * j + 3, 1) = '1')::INT + 2 * (substr(bits, 5 * j + 4, 1) = '1')::INT + (substr(bits, 5 * j + 5, 1) = '1')::INT, 1)), '') AS digest, min(page_id) OVER (PARTITION BY hex) AS first_id FROM b)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, TRUE AS verified FROM d
"""

#: crc32 in SQL: the table of all bytes, and the bytes of a text of code points below 0x800.
CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table"


def _crc_sql(text: str) -> str:
    codes = f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN ord(ch) < 128 THEN [CAST(ord(ch) AS BIGINT)] ELSE [CAST(192 + (ord(ch) >> 6) AS BIGINT), CAST(128 + (ord(ch) & 63) AS BIGINT)] END))"
    return f"xor(list_reduce([4294967295] || {codes}, lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"


def _edit(state: str, cost: int | str, letter: str, line: str = "") -> str:
    turns = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {turns}}} END"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _stay(initial: str, state: str, line: str) -> str:
    return f"CASE WHEN NOT required AND initial = '{initial}' THEN {_edit(state, 'penalty', 'K', line)} END"


def _become(state: str, role: str) -> str:
    changed = f"'{role}:' || text"
    return f"CASE WHEN NOT required THEN {_edit(state, '1 + penalty', 'R', changed)} END"


_LINE = "role || ':' || text"
_E2 = _least("s2", *(_edit(s, 5, "I", "'user:'") for s in ("s0", "s1", "s3")))
_E3 = _least("s3", _edit("e2", 5, "I", "'assistant:'"))
#: States s0 to s3 hold the least (cost, audit) with its lines; e2 and e3 are s2 and s3 with insertions.
REPAIR_SQL = f"""WITH RECURSIVE crc AS ({CRC_TABLE}),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM k) WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
f AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS repeated, regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS ended, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
r AS (SELECT *, blank OR repeated AS required, CASE WHEN ended THEN 0 ELSE 5 END AS penalty FROM f),
sums AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND repeated) AS duplicate, count(*) FILTER (NOT blank AND NOT repeated AND NOT ended) AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
st AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s0, NULL::STRUCT(c INT, a VARCHAR, t VARCHAR[]) AS s1, NULL::STRUCT(c INT, a VARCHAR, t VARCHAR[]) AS s2, NULL::STRUCT(c INT, a VARCHAR, t VARCHAR[]) AS s3 FROM sums
UNION ALL SELECT conv_id, i, {_edit("s0", 2, "D")}, {_least(_edit("s1", 2, "D"), _stay("s", "s0", _LINE))}, {_least(_edit("e2", 2, "D"), *(_stay("u", s, _LINE) for s in ("s0", "s1", "e3")), *(_become(s, "user") for s in ("s0", "s1", "e3")))}, {_least(_edit("e3", 2, "D"), _stay("a", "e2", _LINE), _become("e2", "assistant"))}
FROM (SELECT *, {_E3} AS e3 FROM (SELECT r.conv_id, r.i, r.role, r.text, r.initial, r.required, r.penalty, s0, s1, s3, {_E2} AS e2 FROM st JOIN r ON r.conv_id IS NOT DISTINCT FROM st.conv_id AND r.i = st.i + 1))),
best AS (SELECT conv_id, {_least("s0", _E3)} AS b FROM (SELECT st.*, {_E2} AS e2 FROM st JOIN sums ON st.conv_id IS NOT DISTINCT FROM sums.conv_id AND st.i = sums.n))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums ON c.conv_id IS NOT DISTINCT FROM sums.conv_id LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id"""

#: Two words are near if one less letter makes the other, or both the same with the letter gone at one place.
VARIANTS_SQL = f"""WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY 1, 2),
h AS (SELECT run, n, {_crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc WHERE length(run) >= 6),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h) WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
less AS (SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM v)),
pairs AS (SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word UNION SELECT less.word, v.word FROM less JOIN v ON v.word = less.rest UNION SELECT v.word, less.word FROM less JOIN v ON v.word = less.rest),
f AS (SELECT v.word, v.n, count(o.word) AS n_near, first(o.word ORDER BY o.n DESC, o.word) AS best, max(o.n) AS best_n FROM v LEFT JOIN pairs ON pairs.word = v.word LEFT JOIN v o ON o.word = pairs.other GROUP BY 1, 2),
g AS (SELECT word, n, n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM f),
up AS (SELECT word, word AS root, 0 AS steps FROM g UNION ALL SELECT up.word, g.form, steps + 1 FROM up JOIN g ON g.word = up.root WHERE g.form IS NOT NULL)
SELECT g.word, form, root, n, n_near, form_n FROM g JOIN (SELECT word, arg_max(root, steps) AS root FROM up GROUP BY word) USING (word)"""

ORACLES: dict[str, str] = {"op5_warc": WARC_SQL, "op12_conversation_repair": REPAIR_SQL, "op13_spelling_variants": VARIANTS_SQL}
