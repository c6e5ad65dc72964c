"""The registered queries of this subpackage, over whole tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import bpe, decontaminate, exact_dedup, html_text, minmax_dedup, ngram_join, pii, spelling, substring_dedup, token_files, toxicity, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
END_ID = 2


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), END_ID)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest, html FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM m
"""


@query("op3_warc", OP3)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


@query("op4_personal_data")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


OP5 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS same FROM documents
), g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY same) AS group_size FROM d
  WINDOW w AS (PARTITION BY same ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(same) AS text_sha256 FROM g
"""


@query("op5_exact_dedup", OP5)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


@query("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_text.main_texts(pages, html_text.train(pages))


OP7 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bx AS (
  SELECT item_id, w, len(w) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0
), q AS (SELECT DISTINCT item_id, least(n, 10) AS k, list_slice(w, i, i + least(n, 10) - 1) AS s FROM bx),
sizes AS (SELECT DISTINCT k FROM q),
dx AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM dw, sizes WHERE len(w) >= k),
hits AS (
  SELECT dx.doc_id, dx.i, dx.k, q.item_id FROM dx JOIN q ON q.k = dx.k AND q.s = list_slice(dx.w, dx.i, dx.i + dx.k - 1)
), covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op7_decontamination", OP7)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    return found.drop("longest")


OP8 = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM dw WHERE len(w) >= 13),
s AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 12), ' ')) AS h FROM x),
late AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS least FROM s) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM dw),
kept AS (
  SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY words.doc_id
)
SELECT dw.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (doc_id)
"""


@query("op8_substring_dedup", OP8)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False).drop("kept")


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), _pattern())


OP10 = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM both_ JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 85 * (a.n + b.n - k)),
r AS (SELECT doc_id AS id, doc_id AS reach FROM dw UNION SELECT r.id, e.v FROM r JOIN e ON e.u = r.reach),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT dw.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, dw.doc_id = component_id AS kept
FROM dw LEFT JOIN n USING (doc_id) JOIN c ON c.id = dw.doc_id
"""


@query("op10_minmax_dedup", OP10)
def op10_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_groups(_table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


OP12 = (
    OP10.replace("list_slice(w, i, i + 4)", "list_slice(w, i, i + 2)")
    .replace("greatest(len(w) - 4, 1)", "greatest(len(w) - 2, 1)")
    .replace(">= 85 *", ">= 90 *")
    .replace(", dw.doc_id = component_id AS kept", "")
)


@query("op12_ngram_join", OP12)
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"))


# crc32 bit by bit; runs of under six letters give no words
OP13 = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS r FROM documents) WHERE length(r) >= 6
), often AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, k, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: unicode(c)::BIGINT) AS points FROM often
), bits AS (
  SELECT doc_id, run, k, flatten(list_transform(
    flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END)),
    lambda b: [b & 1, (b >> 1) & 1, (b >> 2) & 1, (b >> 3) & 1, (b >> 4) & 1, (b >> 5) & 1, (b >> 6) & 1, (b >> 7) & 1])) AS bits FROM bytes
), sums AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, bits),
    lambda c, b: CASE WHEN xor(c & 1, b) = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT) AS h FROM bits
), made AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k FROM sums
), words AS (SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
gaps AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word
), best AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.r = 1
), chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""


@query("op13_spelling_variants", OP13)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))
