"""Queries over tokens, tags, term scores and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.constants import ASCII_PUNCT, CJK_PUNCT, CASED, CONLL_TYPES, END_POS, END_TOKEN, WORD, digit_class, numeric_class
from tagloom.functions.sql import register
from tagloom.functions.text import is_alnum, words_of
from tagloom.operators import aggregates as ag
from tagloom.operators import dictionaries as dc
from tagloom.operators import joins as jo
from tagloom.operators import metrics as mt
from tagloom.operators import sequences as sq
from tagloom.operators import tags as tg
from tagloom.operators import tokens as tk
from tagloom.operators.columns import map_tag_type
from tagloom.operators.features import NEIGHBOUR_SHAPES, SHAPES, FeatureConfig, feature_columns, feature_table, token_shapes
from tagloom.plans import inputs as inp
from tagloom.plans import recipes
from tagloom.plans.registry import query, table
from tagloom.session import work_folder
from tagloom.sources.lexicons import stack_lexicons

# ---- token tables -------------------------------------------------------------


@query(
    "tag_distribution",
    f"""WITH {inp.DOC_CHARS}, n AS (SELECT ner, count(*) AS cnt FROM chars GROUP BY 1)
        SELECT ner, cnt, round(cnt * 100.0::DOUBLE / (SELECT sum(cnt) FROM n), 3) AS percentage FROM n""",
)
def tag_distribution(spark, d):
    return ag.tag_distribution(inp.document_chars(spark, d))


@query("char_bilou", f"WITH {inp.CONV_CHARS} SELECT * FROM chars")
def char_bilou(spark, d):
    return inp.conversation_chars(spark, d)


@query(
    "char_bilou_lines",
    f"""WITH {inp.DOC_CHARS} SELECT doc_id, sent_id, count(*) AS n_chars,
        count(*) FILTER (WHERE ner = 'B-w') AS n_begin, count(*) FILTER (WHERE ner = 'L-w') AS n_last,
        count(*) FILTER (WHERE ner = 'U-w') AS n_unit, count(*) FILTER (WHERE ner = 'O') AS n_out,
        CAST(sum(tok_id) AS BIGINT) AS place_sum FROM chars GROUP BY 1, 2""",
)
def char_bilou_lines(spark, d):
    return inp.document_chars(spark, d).groupBy("doc_id", "sent_id").agg(
        F.count(F.lit(1)).alias("n_chars"),
        *[F.count_if(F.col("ner") == t).alias(n) for t, n in
          (("B-w", "n_begin"), ("L-w", "n_last"), ("U-w", "n_unit"), ("O", "n_out"))],
        F.sum("tok_id").alias("place_sum"),
    )


@query("sentence_tokens", f"WITH {inp.CONV_TOKENS} SELECT doc_id, sent_id, tok_id, token FROM toks")
def sentence_tokens(spark, d):
    return inp.conversation_tokens(spark, d)


@query("sql_functions", f"WITH {inp.CONV_TOKENS} SELECT doc_id, sent_id, tok_id, {inp.title_sql('token')} AS token FROM toks WHERE {inp.alnum_sql('token')}")
def sql_functions(spark, d):
    """Tokens of the conversations in title case, by functions under SQL names."""
    register(spark)
    inp.conversations(spark, d).createOrReplaceTempView("conversation_turns")
    return spark.sql(
        """SELECT doc_id, sent_id, tok_id, title_case(token) AS token
           FROM (SELECT doc_id, inline(r) FROM (SELECT doc_id, sentence_tokens(text) AS r FROM conversation_turns)) WHERE is_alnum(token)"""
    )


@query(
    "sentence_sizes",
    f"""WITH {inp.DOC_TOKENS} SELECT doc_id, sent_id, count(*) AS n_tokens, CAST(sum(length(token)) AS BIGINT) AS n_chars
        FROM toks GROUP BY 1, 2""",
)
def sentence_sizes(spark, d):
    return inp.document_tokens(spark, d).groupBy("doc_id", "sent_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.sum(F.length("token")).alias("n_chars")
    )


@query(
    "with_end_rows",
    f"""WITH {inp.CONV_TOKENS} SELECT doc_id, sent_id, tok_id, token, 'O' AS ner, 'X' AS pos FROM toks
        UNION ALL SELECT doc_id, sent_id, (max(tok_id) + 1)::INTEGER, '{END_TOKEN}', 'O', '{END_POS}' FROM toks GROUP BY 1, 2""",
)
def with_end_rows(spark, d):
    tokens = inp.conversation_tokens(spark, d).withColumns({"ner": F.lit("O"), "pos": F.lit("X")})
    return tk.with_end_rows(tokens)


_DENSE = f"""{inp.CONV_TOKENS}, dense AS (SELECT doc_id, token, dense_rank() OVER (PARTITION BY doc_id ORDER BY sent_id) - 1
  AS sent_id, row_number() OVER (PARTITION BY doc_id ORDER BY sent_id, tok_id) - 1 AS n FROM toks)"""


@query("sentence_ids", f"WITH {_DENSE} SELECT doc_id, CAST(n + sent_id AS INTEGER) AS tok_id, token, sent_id FROM dense")
def sentence_ids(spark, d):
    flat = tk.tokens_with_ends(inp.conversations(spark, d)).select("doc_id", "tok_id", "token")
    return sq.sentence_ids(flat, block_rows=64).select("doc_id", "tok_id", "token", F.col("sent_id").cast("long").alias("sent_id"))


@query(
    "delimiter_rows",
    f"WITH {_DENSE} SELECT doc_id, CAST(max(n + sent_id) + 1 AS INTEGER) AS tok_id FROM dense GROUP BY doc_id, sent_id",
)
def delimiter_rows(spark, d):
    return sq.delimiter_rows(tk.tokens_with_ends(inp.conversations(spark, d)))


_MARKED = r"""marked AS (SELECT doc_id, line_no AS sent_id, regexp_replace(value, '^([^ ]+) ([^ ]+) ([^ ]+)',
  '||\1 \2||person||| ||\3||company|||') AS sentence FROM lines)"""


@query(
    "markup_to_bilou",
    rf"""WITH {inp.DOCS}, {inp.lines_sql('docs')}, {_MARKED},
    w AS (SELECT doc_id, sent_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS w FROM
      (SELECT doc_id, sent_id, {inp.words_sql('sentence')} AS l FROM marked WHERE contains(sentence, '||'))),
    b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY i) AS k FROM w WHERE starts_with(w, '||')),
    e AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY i) AS k FROM w WHERE contains(w, '|||')),
    p AS (SELECT b.doc_id, b.sent_id, b.k, b.i AS bi, e.i AS ei, CASE WHEN contains(e.w, 'company|||') THEN 'COM'
      WHEN contains(e.w, 'person|||') THEN 'PPL' END AS kind FROM b JOIN e USING (doc_id, sent_id, k)),
    t AS (SELECT w.doc_id, w.sent_id, w.i, w.w, arg_max(CASE WHEN bi = ei THEN 'U-' WHEN bi = w.i THEN 'B-'
      WHEN ei = w.i THEN 'L-' ELSE 'I-' END || kind, (kind = 'COM')::INTEGER * 1000000 + p.k) AS ner
      FROM w LEFT JOIN p ON p.doc_id = w.doc_id AND p.sent_id = w.sent_id AND w.i BETWEEN bi AND ei AND kind IS NOT NULL
      GROUP BY 1, 2, 3, 4)
    SELECT doc_id, sent_id, i::INTEGER AS tok_id, replace(replace(replace(w, '||person', ''), '||company', ''), '|', '')
      AS token, coalesce(ner, 'O') AS ner FROM t""",
)
def markup_to_bilou(spark, d):
    lines = tk.document_lines(inp.documents(spark, d))
    marked = F.regexp_replace("value", "^([^ ]+) ([^ ]+) ([^ ]+)", "||$1 $2||person||| ||$3||company|||")
    return tk.markup_to_bilou(lines.select("doc_id", F.col("line_no").alias("sent_id"), marked.alias("sentence")))


@query(
    "iob_to_bilou",
    f"""WITH {inp.CONV_TOKENS}, iob AS (SELECT *, {inp.IOB_SQL} AS ner FROM toks),
    n AS (SELECT *, lead(ner, 1, 'O') OVER (PARTITION BY doc_id, sent_id ORDER BY tok_id) AS nx FROM iob)
    SELECT doc_id, sent_id, tok_id, token, CASE WHEN nx = 'O' AND ner LIKE 'B-%' THEN 'U-' || substr(ner, 3)
    WHEN nx = 'O' AND ner LIKE 'I-%' THEN 'L-' || substr(ner, 3) ELSE ner END AS ner FROM n""",
)
def iob_to_bilou(spark, d):
    return sq.iob_to_bilou(inp.with_iob(inp.conversation_tokens(spark, d)))


@query(
    "iob_to_bilou_blocks",
    f"""WITH {inp.CONV_TOKENS}, iob AS (SELECT *, {inp.IOB_SQL} AS ner FROM toks),
    n AS (SELECT *, lead(ner, 1, 'O') OVER (PARTITION BY doc_id, sent_id ORDER BY tok_id) AS nx FROM iob)
    SELECT doc_id, sent_id, tok_id, token, CASE WHEN (nx = 'O' OR nx LIKE 'B-%') AND ner LIKE 'B-%'
    THEN 'U-' || substr(ner, 3) WHEN (nx = 'O' OR nx LIKE 'B-%') AND ner LIKE 'I-%' THEN 'L-' || substr(ner, 3)
    ELSE ner END AS ner FROM n""",
)
def iob_to_bilou_blocks(spark, d):
    return sq.iob_to_bilou(inp.with_iob(inp.conversation_tokens(spark, d)), strict=True, block_rows=5)


_REBUILT = f"""{inp.DOC_CHARS}, pert AS (SELECT doc_id, sent_id, tok_id, token, CASE WHEN {inp.RULE} = 0 THEN 'I-w'
    WHEN {inp.RULE} = 5 THEN 'U-w' ELSE ner END AS ner FROM chars),
    seg AS (SELECT *, ner IN ('L-w', 'U-w', 'O') AS c, coalesce(sum((ner IN ('L-w', 'U-w', 'O'))::INTEGER) OVER (PARTITION BY
    doc_id, sent_id ORDER BY tok_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM pert),
    wd AS (SELECT doc_id, sent_id, s::INTEGER AS word_id, string_agg(token, '' ORDER BY tok_id) AS word
    FROM seg GROUP BY 1, 2, 3 HAVING bool_or(c))"""


@query("rebuild_words", f"WITH {_REBUILT} SELECT doc_id, sent_id, word_id, word FROM wd")
def rebuild_words(spark, d):
    return sq.rebuild_words(inp.perturbed_chars(inp.document_chars(spark, d, packed=True)))


@query(
    "rebuild_lines",
    f"WITH {_REBUILT} SELECT doc_id, sent_id, string_agg(word, ' ' ORDER BY word_id) AS value FROM wd GROUP BY 1, 2",
)
def rebuild_lines(spark, d):
    return sq.words_to_lines(sq.rebuild_words(inp.perturbed_chars(inp.document_chars(spark, d, packed=True)), packed=True))


_LAGS = """ctx AS (SELECT *, lag(token, 1) OVER w AS p1, lag(token, 2) OVER w AS p2, lead(token, 1) OVER w AS n1,
  lead(token, 2) OVER w AS n2 FROM {source} WINDOW w AS (PARTITION BY doc_id, sent_id ORDER BY tok_id))"""
_CONTEXT = """p1 || token AS previous1cur, p2 || p1 || token AS previous2cur, token || n1 AS cur_next1,
  token || n1 || n2 AS cur_next2, CASE WHEN p1 IS NULL THEN true END AS "BOS", CASE WHEN n1 IS NULL THEN true END AS "EOS\""""


@query(
    "context_features",
    f"WITH {inp.CONV_TOKENS}, {_LAGS.format(source='toks')} SELECT doc_id, sent_id, tok_id, token, {_CONTEXT} FROM ctx",
)
def context_features(spark, d):
    return sq.context_features(inp.conversation_tokens(spark, d))


def _shape_sql(name: str, c: str) -> str:
    return {
        "original": c,
        "lower": f"lower({c})",
        "last3": f"right({c}, 3)",
        "last2": f"right({c}, 2)",
        "first3": f"left({c}, 3)",
        "first2": f"left({c}, 2)",
        "isupper": f"({c} = upper({c}) AND {c} <> lower({c}))",
        "istitle": f"({c} = {inp.title_sql(c)} AND regexp_matches({c}, '[{CASED}]'))",
        "isdigit": f"regexp_matches({c}, '^[{digit_class()}]+$')",
        "islower": f"({c} = lower({c}) AND {c} <> upper({c}))",
    }[name]


_SHAPE_CONFIG = FeatureConfig(shapes=tuple(SHAPES), neighbour_shapes=tuple(NEIGHBOUR_SHAPES), reach=1)
_SHAPES_SQL = ", ".join(
    [f"{_shape_sql(n, 'token')} AS current_{n}" for n in SHAPES]
    + [f"{_shape_sql(n, c)} AS {side}1_{n}" for side, c in (("previous", "p1"), ("next", "n1")) for n in NEIGHBOUR_SHAPES]
)


@query(
    "token_shape",
    f"WITH {inp.CONV_TOKENS}, {_LAGS.format(source='toks')} SELECT doc_id, sent_id, tok_id, {_SHAPES_SQL} FROM ctx",
)
def token_shape(spark, d):
    return token_shapes(inp.conversation_tokens(spark, d), _SHAPE_CONFIG).drop("token")


# ---- lexicons and features -------------------------------------------------------

LEXICONS = ["item", "known", "place"]
_LEX = f"""bw AS (SELECT DISTINCT unnest({inp.words_sql('text')}) AS token, item_id FROM benchmark),
  item AS (SELECT token, max(item_id::VARCHAR) AS v FROM bw GROUP BY 1),
  place AS (SELECT DISTINCT unnest(string_split(r_name || ' ' || n_name, ' ')) AS token FROM region JOIN nation ON r_regionkey = n_regionkey)"""
_LEX_JOIN = """lx AS (SELECT t.*, coalesce(i.v, '0') AS item, CASE WHEN i.token IS NULL THEN '0' ELSE 'True' END AS known,
  CASE WHEN p.token IS NULL THEN '0' ELSE 'True' END AS place FROM toks t LEFT JOIN item i ON i.token = t.token
  LEFT JOIN place p ON p.token = t.token)"""


def _lexicons(spark, d):
    words = table(spark, d, "benchmark").select(F.explode(words_of("text")).alias("token"), "item_id").distinct()
    places = (
        table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.explode(F.split(F.concat_ws(" ", "r_name", "n_name"), " ")).alias("token")).distinct()
    )
    return stack_lexicons({"item": words, "known": words.select("token").distinct(), "place": places})


@query(
    "lexicon_features",
    f"WITH {inp.CONV_TOKENS}, {_LEX}, {_LEX_JOIN} SELECT doc_id, sent_id, tok_id, token, item, known, place FROM lx",
)
def lexicon_features(spark, d):
    return jo.add_lexicons(inp.conversation_tokens(spark, d), _lexicons(spark, d), LEXICONS)


@query(
    "lexicon_flags",
    f"""WITH {inp.DOC_TOKENS}, {_LEX} SELECT doc_id, count(*) AS n, count(i.token) AS hits FROM toks t
        LEFT JOIN item i ON i.token = lower(t.token) GROUP BY 1""",
)
def lexicon_flags(spark, d):
    flagged = jo.add_lexicons(
        inp.document_tokens(spark, d), _lexicons(spark, d), ["known"], lower=True, kind="flag"
    )
    return flagged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("known") == "1").alias("hits"))


TABLE_CONFIG = FeatureConfig(
    shapes=("original", "lower", "last3", "isupper", "isdigit"), lexicons=tuple(LEXICONS), pos=True
)


def _feature_text_sql() -> str:
    parts = ["'bias'"]
    for n in TABLE_CONFIG.shapes:
        sql = _shape_sql(n, "token")
        parts.append(f"CASE WHEN {sql} THEN 'current_{n}' END" if n.startswith("is") else f"'current_{n}=' || {sql}")
    for n in LEXICONS:
        parts.append(f"CASE WHEN {n} = 'True' THEN 'current_{n}' ELSE 'current_{n}=' || {n} END")
    parts.append("'current_pos=' || pos")
    for k in (1, 2):
        parts += [f"'previous{k}cur=' || previous{k}cur", f"'cur_next{k}=' || cur_next{k}"]
    parts += ["CASE WHEN \"BOS\" THEN 'BOS' END", "CASE WHEN \"EOS\" THEN 'EOS' END"]
    return f"concat_ws(' ', {', '.join(parts)})"


@query(
    "feature_table",
    f"""WITH {inp.CONV_TOKENS}, {_LEX}, {_LEX_JOIN}, {_LAGS.format(source='lx')},
    f AS (SELECT *, CASE WHEN {_shape_sql('isdigit', 'token')} THEN 'NUM' ELSE 'X' END AS pos, {inp.TRUTH_SQL} AS label,
    {_CONTEXT} FROM ctx)
    SELECT doc_id, sent_id, tok_id, token, label, {_feature_text_sql()} AS features FROM f""",
)
def features(spark, d):
    tokens = inp.with_truth(inp.conversation_tokens(spark, d), "ner").withColumn(
        "pos", F.when(SHAPES["isdigit"](F.col("token")), "NUM").otherwise("X")
    )
    columns = feature_columns(tokens, TABLE_CONFIG, _lexicons(spark, d))
    return feature_table(columns, TABLE_CONFIG).withColumn("features", F.array_join("features", " "))


# ---- tags ------------------------------------------------------------------------------


@query(
    "map_or_null",
    f"""WITH {inp.CONV_TOKENS}, iob AS (SELECT *, {inp.IOB_SQL} AS ner FROM toks)
    SELECT doc_id, sent_id, tok_id, CASE WHEN ner = 'O' THEN 'O' WHEN substr(ner, 3) = 'ORG' THEN substr(ner, 1, 2) || 'COM'
    WHEN substr(ner, 3) = 'PER' THEN substr(ner, 1, 2) || 'PPL' END AS ner FROM iob""",
)
def map_or_null(spark, d):
    types = {k: v for k, v in CONLL_TYPES.items() if k in ("ORG", "PER")}
    tokens = inp.with_iob(inp.conversation_tokens(spark, d))
    return tokens.select("doc_id", "sent_id", "tok_id", map_tag_type("ner", types).alias("ner"))


@query(
    "collapse_tags",
    f"""WITH {inp.DOC_TOKENS}, {inp.TRUTH_TOKENS}
    SELECT doc_id, CASE WHEN truth LIKE '%-GPE' THEN 'O' ELSE truth END AS ner, count(*) AS cnt FROM truths GROUP BY 1, 2""",
)
def collapse_tags(spark, d):
    tokens = inp.with_truth(inp.document_tokens(spark, d))
    return tokens.groupBy("doc_id", tg.collapse_tags("truth").alias("ner")).agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "keep_tag_types",
    f"""WITH {inp.CONV_TOKENS}, {inp.TRUTH_TOKENS} SELECT doc_id, sent_id, tok_id,
        CASE WHEN truth LIKE '%PPL' OR truth LIKE '%GPE' THEN truth ELSE 'O' END AS ner FROM truths""",
)
def keep_tag_types(spark, d):
    tokens = inp.with_truth(inp.conversation_tokens(spark, d))
    return tokens.select("doc_id", "sent_id", "tok_id", tg.keep_tag_types("truth", ["PPL", "GPE"]).alias("ner"))


@query(
    "vote_two",
    f"""WITH {inp.CONV_TOKENS}, m AS (SELECT *, {inp.model_tag_sql(0)} AS a, {inp.model_tag_sql(1)} AS b FROM toks)
    SELECT doc_id, sent_id, tok_id, token, CASE WHEN a LIKE '%COM' THEN a WHEN b LIKE '%COM' THEN 'O' ELSE b END AS ner FROM m""",
)
def vote_two(spark, d):
    tokens = inp.conversation_tokens(spark, d)
    tags = inp.model_tags(tokens, ["COM", "PPL"])
    tables = {n: tags.select("doc_id", "sent_id", "tok_id", "token", F.col(n).alias("ner")) for n in ("COM", "PPL")}
    return tg.vote_tables(tables)


@query(
    "vote_many",
    f"""WITH {inp.DOC_TOKENS}, m AS (SELECT *, {inp.model_tag_sql(0)} AS a, {inp.model_tag_sql(1)} AS b,
    {inp.model_tag_sql(2)} AS c, {inp.model_tag_sql(3)} AS g FROM toks),
    v AS (SELECT doc_id, CASE WHEN a LIKE '%COM' THEN a WHEN b LIKE '%GPE' THEN b WHEN c LIKE '%PPL' THEN c
    WHEN g LIKE '%COM' OR g LIKE '%GPE' OR g LIKE '%PPL' THEN 'O' ELSE g END AS ner FROM m)
    SELECT doc_id, ner, count(*) AS cnt FROM v GROUP BY 1, 2""",
)
def vote_many(spark, d):
    names = ["COM", "GPE", "PPL", "GEN"]
    tags = inp.model_tags(inp.document_tokens(spark, d), names)
    return tags.groupBy("doc_id", tg.vote({n: n for n in names}).alias("ner")).agg(F.count(F.lit(1)).alias("cnt"))


_ENTITIES = """seg AS (SELECT *, truth LIKE 'L-%' OR truth LIKE 'U-%' AS c, coalesce(sum((truth LIKE 'L-%' OR truth LIKE 'U-%')
    ::INTEGER) OVER (PARTITION BY doc_id, sent_id ORDER BY tok_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM truths WHERE truth <> 'O'),
  ent AS (SELECT doc_id, sent_id, s, string_agg(token, ' ' ORDER BY tok_id) AS entity, substr(arg_min(truth, tok_id), 3) AS ner
    FROM seg GROUP BY 1, 2, 3 HAVING bool_or(c)),
  ph AS (SELECT doc_id, entity, ner, count(*) AS cnt FROM ent GROUP BY 1, 2, 3)"""


@query("entity_phrases", f"WITH {inp.DOC_TOKENS}, {inp.TRUTH_TOKENS}, {_ENTITIES} SELECT doc_id, entity, ner, cnt FROM ph")
def entity_phrases(spark, d):
    return tg.entity_phrases(inp.with_truth(inp.dealt_tokens(spark, d)), "truth")


@query(
    "remap_entities",
    f"""WITH {inp.DOC_TOKENS}, {inp.TRUTH_TOKENS}, {_ENTITIES},
    fix AS (SELECT DISTINCT unnest({inp.words_sql('text')}) AS w FROM benchmark)
    SELECT doc_id, entity, CASE WHEN ner = 'PPL' AND entity IN (SELECT w FROM fix) THEN 'COM' ELSE ner END AS ner, cnt
    FROM ph""",
)
def remap_entities(spark, d):
    words = table(spark, d, "benchmark").select(F.explode(words_of("text")).alias("w")).distinct()
    words = words.where(~F.col("w").contains("##"))
    remap = words.select(F.concat("w", F.lit("##PPL")).alias("wrong"), F.concat("w", F.lit("##COM")).alias("correct"))
    return tg.remap_entities(tg.entity_phrases(inp.with_truth(inp.dealt_tokens(spark, d)), "truth"), remap)


@query(
    "enrich_json",
    f"""WITH {inp.CONV_TOKENS}, {inp.TRUTH_TOKENS}, {_ENTITIES},
    keys AS (SELECT doc_id, list_sort(list(entity || '##' || ner || '##' || cnt)) AS ks FROM ph GROUP BY 1)
    SELECT doc_id, len(ks) AS n_phrases, array_to_string(ks, chr(10)) AS phrases, role, text AS content
    FROM conv JOIN keys USING (doc_id)""",
)
def enrich_json(spark, d):
    turns = inp.conversations(spark, d)
    records = turns.select("doc_id", F.struct(F.col("text").alias("content"), "role").alias("DETAIL"))
    phrases = tg.entity_phrases(inp.with_truth(inp.conversation_tokens(spark, d)), "truth")
    lines = recipes.enrich_records(records, tg.phrase_map(phrases), "DETAIL")
    # Read the emitted lines back, as their consumer would.
    schema = "doc_id LONG, DETAIL STRUCT<content: STRING, role: STRING, ner_phrase: MAP<STRING, ARRAY<STRING>>>"
    back = lines.select(F.from_json("value", schema).alias("r"))
    keys = F.sort_array(F.map_keys("r.DETAIL.ner_phrase"))
    return back.where(F.size(keys) > 0).select(
        "r.doc_id", F.size(keys).cast("long").alias("n_phrases"), F.array_join(keys, "\n").alias("phrases"),
        "r.DETAIL.role", "r.DETAIL.content",
    )


# ---- evaluation -----------------------------------------------------------------------


@query(
    "tag_diff",
    f"""WITH {inp.DOC_TOKENS}, {inp.PRED_TOKENS} SELECT doc_id, sent_id, tok_id, token, pred AS bugged_ner,
        truth AS fixed_ner FROM preds WHERE pred <> truth""",
)
def tag_diff(spark, d):
    """Both taggings lie by document, which brings equal tokens together; told so, Spark joins them without moving a token.

    The setting holds for the session. It changes where joins shuffle, not their rows.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    tokens = inp.with_prediction(inp.dealt_tokens(spark, d))
    return tg.tag_diff(tokens.withColumn("ner", F.col("pred")), tokens.withColumn("ner", F.col("truth")))


@query(
    "tag_diff_tables",
    f"""WITH {inp.DOC_TOKENS}, {inp.PRED_TOKENS} SELECT doc_id, sent_id, tok_id, token, pred AS bugged_ner,
        truth AS fixed_ner FROM preds WHERE pred <> truth""",
)
def tag_diff_tables(spark, d):
    """The same over two stored taggings, compared bucket by bucket.

    There are more buckets with more splits of the documents, so that a task sorts one bucket in memory at any size. Texts are
    dealt out to them, in the order of their keys, and tokens are made behind that, so no token moves.
    """
    docs, folder = table(spark, d, "documents"), work_folder(spark, "taggings")
    name, buckets = folder.rsplit("-", 1)[-1], 16 * max(1, docs.rdd.getNumPartitions())
    dealt = docs.select("doc_id", "text").repartition(buckets, "doc_id").sortWithinPartitions("doc_id")
    tokens = inp.with_prediction(tk.sentence_tokens(dealt))
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    saved = [
        tg.save_token_table(
            tokens.select(*tg.TOKEN_KEY, "token", F.col(c).alias("ner")), f"tags_{c}_{name}", f"{folder}/{c}", buckets=buckets, dealt="doc_id"
        )
        for c in ("pred", "truth")
    ]
    return tg.tag_diff(*saved)


@query(
    "tag_false_pos",
    f"""WITH {inp.DOC_TOKENS}, {inp.PRED_TOKENS} SELECT doc_id, sent_id, tok_id, token, pred AS bugged_ner,
        truth AS fixed_ner FROM preds WHERE pred <> truth AND truth = 'O'""",
)
def tag_false_pos(spark, d):
    return tg.false_positives(tag_diff(spark, d))


@query(
    "pred_mismatch",
    f"WITH {inp.DOC_TOKENS}, {inp.PRED_TOKENS} SELECT token, pred, truth FROM preds WHERE pred <> truth",
)
def pred_mismatch(spark, d):
    return mt.mismatches(inp.with_prediction(inp.document_tokens(spark, d))).select("token", "pred", "truth")


@query(
    "token_accuracy",
    f"WITH {inp.DOC_TOKENS}, {inp.PRED_TOKENS} SELECT round(avg((pred = truth)::INTEGER), 6) AS accuracy FROM preds",
)
def token_accuracy(spark, d):
    scored = mt.token_accuracy(inp.with_prediction(inp.document_tokens(spark, d)))
    return scored.select(F.round("accuracy", 6).alias("accuracy"))


def _segments_sql(tag: str) -> str:
    return f"""(SELECT doc_id, sent_id, tok_id, {tag} AS tag, pred = truth AS same, coalesce(sum((left({tag}, 1) IN ('U', 'L'))
      ::INTEGER) OVER (PARTITION BY doc_id, sent_id ORDER BY tok_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
      FROM preds WHERE {tag} <> 'O')"""


@query(
    "entity_metrics",
    f"""WITH {inp.DOC_TOKENS}, {inp.PRED_TOKENS},
    te AS (SELECT split_part(arg_min(tag, tok_id), '-', 2) AS label, bool_and(same) AS ok FROM {_segments_sql('truth')}
      GROUP BY doc_id, sent_id, s),
    pe AS (SELECT split_part(arg_min(tag, tok_id), '-', 2) AS label FROM {_segments_sql('pred')} GROUP BY doc_id, sent_id, s),
    c AS (SELECT t.label, t.n AS support, t.tp, coalesce(p.n, 0) AS selected FROM (SELECT label, count(*) AS n,
      count(*) FILTER (WHERE ok) AS tp FROM te GROUP BY 1) t LEFT JOIN (SELECT label, count(*) AS n FROM pe GROUP BY 1) p
      ON p.label = t.label
      UNION ALL SELECT 'Total', (SELECT count(*) FROM te), (SELECT count(*) FROM te WHERE ok), (SELECT count(*) FROM pe)),
    r AS (SELECT label, support, CASE WHEN selected = 0 THEN 0.0 ELSE tp::DOUBLE / selected END AS p,
      CASE WHEN support = 0 THEN 0.0 ELSE tp::DOUBLE / support END AS r FROM c)
    SELECT label, support, round(p, 4) AS precision, round(r, 4) AS recall,
      round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 4) AS f1 FROM r""",
)
def entity_metrics(spark, d):
    return mt.entity_metrics(inp.with_prediction(inp.dealt_tokens(spark, d)))


def _report_sql(source: str, where: str, digits: int = 3) -> str:
    return f"""WITH {inp.DOC_TOKENS}, {inp.PRED_TOKENS}, s AS ({source}),
    labels AS (SELECT truth AS label FROM s UNION SELECT pred FROM s),
    c AS (SELECT label, (SELECT count(*) FROM s WHERE truth = label) AS support,
      (SELECT count(*) FROM s WHERE pred = label) AS guessed,
      (SELECT count(*) FROM s WHERE pred = label AND truth = label) AS tp FROM labels WHERE {where}),
    r AS (SELECT label, support, CASE WHEN guessed = 0 THEN 0.0 ELSE tp::DOUBLE / guessed END AS p,
      CASE WHEN support = 0 THEN 0.0 ELSE tp::DOUBLE / support END AS r FROM c),
    f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM r)"""


@query(
    "label_report",
    _report_sql("SELECT truth, pred FROM preds", "label NOT IN ('O', 'NER', '')")
    + " SELECT label, support, round(p, 3) AS precision, round(r, 3) AS recall, round(f1, 3) AS f1 FROM f",
)
def label_report(spark, d):
    return mt.label_report(inp.with_prediction(inp.document_tokens(spark, d)))


@query(
    "binary_report",
    _report_sql(
        "SELECT CASE WHEN truth = 'O' THEN '0' ELSE '1' END AS truth, CASE WHEN pred = 'O' THEN '0' ELSE '1' END AS pred"
        " FROM preds", "label = '1'",
    )
    + " SELECT label, support, round(p, 3) AS precision, round(r, 3) AS recall, round(f1, 3) AS f1 FROM f",
)
def binary_report(spark, d):
    return mt.label_report(inp.with_prediction(inp.document_tokens(spark, d)), mode="bin")


@query(
    "weighted_f1",
    _report_sql("SELECT truth, pred FROM preds", "label NOT IN ('O', 'NER', '')")
    + " SELECT round(sum(f1 * support) / sum(support), 6) AS f1 FROM f",
)
def weighted_f1(spark, d):
    scored = mt.weighted_f1(inp.with_prediction(inp.document_tokens(spark, d)))
    return scored.select(F.round("f1", 6).alias("f1"))


# ---- term scores -----------------------------------------------------------------------

_CLEAN = rf"regexp_replace(text, '[{ASCII_PUNCT}{CJK_PUNCT}{numeric_class()}]', '', 'g')"
_TERMS = f"""terms AS MATERIALIZED (SELECT w AS word, count(*) AS tf, count(DISTINCT doc_id) AS df
  FROM (SELECT doc_id, unnest({inp.words_sql(f'lower({_CLEAN})')}) AS w FROM documents) GROUP BY 1)"""
_RATIO, _PRODUCT = "tf::DOUBLE / df", "tf::DOUBLE * df"


def _flag_sql(score: str) -> str:
    return f"""WITH {_TERMS} SELECT word, CASE WHEN stddev_pop(s) OVER () > 0 AND s < avg(s) OVER () THEN 0 ELSE 1 END AS flag
        FROM (SELECT word, {score} AS s FROM terms)"""


@query(
    "word_count",
    f"""SELECT w AS word, count(*) AS cnt FROM (SELECT unnest({inp.words_sql('text')}) AS w FROM documents) GROUP BY 1""",
)
def word_count(spark, d):
    return ag.count_values(inp.documents(spark, d).select(F.explode(words_of("text")).alias("word")), "word")


@query("tf_over_df", f"WITH {_TERMS} SELECT word, round({_RATIO}, 6) AS score FROM terms WHERE {_RATIO} > 1")
def tf_over_df(spark, d):
    scores = ag.tf_over_df(recipes.term_table(inp.documents(spark, d)))
    return scores.where("score > 1").withColumn("score", F.round("score", 6))


@query("tf_times_df", f"WITH {_TERMS} SELECT word, {_PRODUCT} AS score FROM terms WHERE {_PRODUCT} > 1")
def tf_times_df(spark, d):
    return ag.tf_times_df(recipes.term_table(inp.documents(spark, d))).where("score > 1")


@query("token_total", f"WITH {_TERMS} SELECT CAST(sum(tf) AS BIGINT) AS n_tokens FROM terms")
def token_total(spark, d):
    return ag.token_total(recipes.term_table(inp.documents(spark, d)))


@query("tf_over_df_flag", _flag_sql(_RATIO))
def tf_over_df_flag(spark, d):
    return ag.zscore_flag(ag.tf_over_df(recipes.term_table(inp.documents(spark, d))))


@query("tf_times_df_flag", _flag_sql(_PRODUCT))
def tf_times_df_flag(spark, d):
    return ag.zscore_flag(ag.tf_times_df(recipes.term_table(inp.documents(spark, d))))


@query(
    "tfidf_l2",
    f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[{WORD}]+')) AS w FROM documents),
    tf AS (SELECT doc_id, w AS word, count(*) AS tf FROM t WHERE length(w) = 1 GROUP BY 1, 2),
    idf AS (SELECT word, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY 1)
    SELECT doc_id, word, round(tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY doc_id)), 6) AS tfidf
    FROM tf JOIN idf USING (word)""",
)
def tfidf_l2(spark, d):
    return ag.tfidf_l2(inp.documents(spark, d)).withColumn("tfidf", F.round("tfidf", 6))


VOCABULARY = ["the", "of", "and", "de", "que", "en", "der", "von", "la", "missing"]


@query(
    "bag_of_words",
    f"""WITH b AS (SELECT doc_id, regexp_extract_all(lower(text), '[{WORD}]+') AS l FROM documents) SELECT doc_id, """
    + ", ".join(f"len(list_filter(l, lambda w: w = '{v}')) AS n_{v}" for v in VOCABULARY)
    + " FROM b",
)
def bag_of_words(spark, d):
    bag = ag.bag_of_words(inp.documents(spark, d), VOCABULARY)
    return bag.withColumnsRenamed({v: f"n_{v}" for v in VOCABULARY})


@query(
    "sparse_words",
    f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[{WORD}]+')) AS word FROM documents),
        v AS (SELECT word, (row_number() OVER (ORDER BY count(*) DESC, word) - 1)::INTEGER AS id FROM w GROUP BY 1 HAVING count(*) >= 2)
        SELECT doc_id, id, count(*) AS n FROM w JOIN v USING (word) GROUP BY 1, 2""",
)
def sparse_words(spark, d):
    """Bag of words over all words that occur twice, in long form."""
    docs = inp.documents(spark, d)
    vectors = ag.sparse_bag_of_words(docs, ag.vocabulary(docs, least=2))
    pairs = F.explode(F.arrays_zip("indices", "values")).alias("p")
    return vectors.select("doc_id", pairs).select("doc_id", F.col("p.indices").alias("id"), F.col("p.values").cast("long").alias("n"))


@query(
    "dictionary_hits",
    f"""WITH v AS (SELECT DISTINCT w FROM (SELECT unnest({inp.words_sql('text')}) AS w FROM conversations) WHERE length(w) >= 12)
        SELECT doc_id, count(*) AS n_values, min(w) AS least, max(w) AS largest FROM documents JOIN v ON contains(text, w) GROUP BY 1""",
)
def dictionary_hits(spark, d):
    """Which long words of the conversations stand in a document, as words or inside them."""
    words = table(spark, d, "conversations").select(F.explode(words_of("text")).alias("value")).where(F.length("value") >= 12)
    hits = dc.find_values(inp.documents(spark, d), words).select("doc_id", "value").distinct()
    return hits.groupBy("doc_id").agg(F.count("*").alias("n_values"), F.min("value").alias("least"), F.max("value").alias("largest"))


@query(
    "head_tail_words",
    f"""WITH {_TERMS}, dw AS (SELECT DISTINCT doc_id, unnest({inp.words_sql(f'lower({_CLEAN})')}) AS word FROM documents),
    s AS (SELECT doc_id, word, {_RATIO} AS score FROM dw JOIN terms USING (word)),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS r, count(*) OVER (PARTITION BY doc_id)
      AS n FROM s),
    p AS (SELECT *, word || ': ' || round(score, 3)::VARCHAR AS x, n < 5 OR r <= n // 5 AS h FROM r)
    SELECT doc_id, string_agg(x, ', ' ORDER BY r) FILTER (WHERE h) AS head,
      string_agg(x, ', ' ORDER BY r) FILTER (WHERE NOT h) AS tail FROM p GROUP BY 1""",
)
def head_tail_words(spark, d):
    docs = inp.documents(spark, d)
    cleaned = docs.select("doc_id", recipes.remove_punc("text").alias("text"))
    scores = ag.tf_over_df(ag.term_frequencies(cleaned))
    return sq.head_tail_words(ag.scored_document_words(cleaned, scores))


# ---- contrast of documents and conversations ------------------------------------------------

_CORPORA = f"""{inp.CONV},
  a AS (SELECT w AS token, lang AS ner, count(*) AS cnt FROM (SELECT lang, unnest({inp.words_sql('text')}) AS w FROM documents)
    WHERE {inp.alnum_sql('w')} GROUP BY 1, 2),
  b AS (SELECT w AS token, role AS ner, count(*) AS cnt FROM (SELECT role, unnest({inp.words_sql('text')}) AS w FROM conv)
    WHERE {inp.alnum_sql('w')} GROUP BY 1, 2)"""
_MUTUAL = f"""{_CORPORA}, mutual AS (SELECT token, a.ner AS ner_x, a.cnt AS count_x, b.ner AS ner_y, b.cnt AS count_y,
  a.cnt::DOUBLE / b.cnt AS ratio FROM a JOIN b USING (token))"""


def _corpora(spark, d):
    out = []
    for df, label in ((inp.documents(spark, d), "lang"), (inp.conversations(spark, d), "role")):
        words = df.select(F.explode(words_of("text")).alias("token"), F.col(label).alias("ner"))
        counted = words.where(is_alnum("token")).groupBy("token", "ner").agg(F.count(F.lit(1)).alias("cnt"))
        out.append(counted)
    return out


@query("corpus_mutual", f"WITH {_MUTUAL} SELECT token, ner_x, count_x, ner_y, count_y, round(ratio, 6) AS ratio FROM mutual")
def corpus_mutual(spark, d):
    a, b = _corpora(spark, d)
    return ag.mutual_ratio(ag.token_counts(a), ag.token_counts(b)).withColumn("ratio", F.round("ratio", 6))


@query("corpus_only_a", f"WITH {_CORPORA} SELECT token, ner, cnt FROM a WHERE token NOT IN (SELECT token FROM b)")
def corpus_only_a(spark, d):
    a, b = _corpora(spark, d)
    return jo.only_in(a, b, "token")


@query("corpus_only_b", f"WITH {_CORPORA} SELECT token, ner, cnt FROM b WHERE token NOT IN (SELECT token FROM a)")
def corpus_only_b(spark, d):
    a, b = _corpora(spark, d)
    return jo.only_in(b, a, "token")


def _keywords_sql(count: str, cut: str, own: str, other: str) -> str:
    return f"""WITH {_MUTUAL}, pool AS (SELECT token, {count} AS cnt FROM mutual WHERE ratio {cut}
      UNION ALL SELECT token, cnt FROM {own} WHERE token NOT IN (SELECT token FROM {other}))
      SELECT token FROM pool WHERE cnt > (SELECT quantile_cont(cnt, 0.75) FROM pool)"""


@query("corpus_keywords_a", _keywords_sql("count_x", "> (SELECT quantile_cont(ratio, 0.75) FROM mutual)", "a", "b"))
def corpus_keywords_a(spark, d):
    return ag.contrast_keywords(*_corpora(spark, d))


@query("corpus_keywords_b", _keywords_sql("count_y", "< (SELECT quantile_cont(ratio, 0.25) FROM mutual)", "b", "a"))
def corpus_keywords_b(spark, d):
    return ag.contrast_keywords(*_corpora(spark, d), first=False)
