"""Queries over columns, joins, dates, nested fields and global order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.constants import ASCII_PUNCT, CJK_PUNCT, COMPANY_TYPES, numeric_class
from tagloom.functions import text as fx
from tagloom.functions import times as tm
from tagloom.operators import aggregates as ag
from tagloom.operators import columns as co
from tagloom.operators import joins as jo
from tagloom.operators import ranking as rk
from tagloom.operators import tokens as tk
from tagloom.plans import inputs as inp
from tagloom.plans import recipes
from tagloom.plans.registry import query, table
from tagloom.session import work_folder
from tagloom.sources.writers import write_chunked

# ---- sources and projections -------------------------------------------------


@query("json_project", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_project(spark, d):
    parsed = F.from_json("props", "k INT")
    return table(spark, d, "events").select("event_id", "event_type", parsed["k"].alias("k"))


@query("doc_lines", f"WITH {inp.lines_sql('documents')} SELECT doc_id, line_no, value FROM lines")
def doc_lines(spark, d):
    return tk.document_lines(inp.documents(spark, d))


@query("schema_normalise", "SELECT p_name AS name, p_partkey AS part_id, p_type AS kind, p_size AS size FROM part")
def schema_normalise(spark, d):
    df = table(spark, d, "part").drop("p_brand", "p_retailprice")
    for old, new in {"p_partkey": "part_id", "p_name": "name", "p_type": "kind", "p_size": "size"}.items():
        df = co.rename(df, old, new)
    return co.reorder(df, ["name", "part_id", "kind", "size"])


@query("filter_lang", r"SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en' AND text <> '\N'")
def filter_lang(spark, d):
    df = co.filter_ne(co.filter_eq(table(spark, d, "documents"), "lang", "en"), "text", "\\N")
    return df.select("doc_id", "source", "n_chars")


@query(
    "classify_type",
    """SELECT doc_id AS entity_name, CASE WHEN source LIKE '%src1%' THEN 'PERSON' WHEN source LIKE '%src2%' THEN 'GPE'
       WHEN source LIKE '%src3%' THEN 'ORG' ELSE 'MISC' END AS entity_type
       FROM documents WHERE lang = 'en' AND regexp_matches(source, 'src1|src2|src3')""",
)
def classify_type(spark, d):
    return recipes.typed_titles(
        table(spark, d, "documents").select("lang", "doc_id", "source"),
        language=("lang", "en"), title="doc_id", kind="source",
        cases=[("src1", "PERSON"), ("src2", "GPE"), ("src3", "ORG")],
    )


MATCH_WORDS = ["the", "von", "que le", "a.b", "!!", "(c)", "$$$"]


@query(
    "match_any",
    "SELECT doc_id, " + " OR ".join(f"contains(text, '{w}')" for w in MATCH_WORDS) + " AS hit FROM documents",
)
def match_any(spark, d):
    return inp.documents(spark, d).select("doc_id", fx.matches_any("text", MATCH_WORDS).alias("hit"))


@query(
    "startswith_any",
    "SELECT p_partkey, starts_with(p_name, 'red') OR starts_with(p_name, 'small b') AS hit FROM part",
)
def startswith_any(spark, d):
    return table(spark, d, "part").select("p_partkey", fx.startswith_any("p_name", ["red", "small b"]).alias("hit"))


_REMAPPED = """WITH typed AS (SELECT o_orderkey, c_mktsegment, o_orderpriority AS short_name
    FROM orders JOIN customer ON o_custkey = c_custkey)
  SELECT o_orderkey, short_name, CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'ORG' ELSE 'MISC' END
    AS new_entity_type FROM typed WHERE len(string_split(short_name, ' ')) """


def _short_names(spark, d):
    types = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("entity_type"))
    names = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", F.col("o_orderpriority").alias("short_name")
    )
    return recipes.short_names(types, names, "id", ["MACHINERY", "BUILDING"], keep=["o_orderkey"])


@query("name_single", _REMAPPED + "= 1")
def name_single(spark, d):
    return _short_names(spark, d)[0]


@query("name_multi", _REMAPPED + "> 1")
def name_multi(spark, d):
    return _short_names(spark, d)[1]


@query(
    "remap_segment",
    "SELECT c_custkey, CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'ORG' ELSE 'MISC' END AS label"
    " FROM customer",
)
def remap_segment(spark, d):
    label = co.remap_labels("c_mktsegment", ["FURNITURE", "HOUSEHOLD"], "ORG")
    return table(spark, d, "customer").select("c_custkey", label.alias("label"))


@query(
    "remap_company",
    "SELECT p_partkey, CASE WHEN p_code IN (" + ", ".join(f"'{t}'" for t in COMPANY_TYPES) + ") THEN 'ORG' ELSE 'MISC'"
    " END AS label FROM (SELECT p_partkey, substr(upper(p_type), 1, 3) AS p_code FROM part)",
)
def remap_company(spark, d):
    code = F.upper(F.substring("p_type", 1, 3))
    return table(spark, d, "part").select("p_partkey", co.remap_labels(code, COMPANY_TYPES, "ORG").alias("label"))


@query(
    "cast_cols",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_shipdate AS DATE)::VARCHAR
       AS l_shipdate, TRY_CAST(l_linestatus AS INTEGER) AS l_linestatus FROM lineitem""",
)
def cast_cols(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_linestatus")
    df = co.cast_columns(df, ["l_quantity"], "int")
    df = co.cast_columns(df, ["l_linestatus"], "int", lenient=True)
    return co.cast_columns(co.cast_columns(df, ["l_shipdate"], "date"), ["l_shipdate"], "string")


# ---- joins ----------------------------------------------------------------------


@query(
    "join_inner",
    """SELECT o_orderkey, c_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_name IS NOT NULL AND o_totalprice IS NOT NULL""",
)
def join_inner(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return jo.join_inner(orders, table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")


@query(
    "join_all",
    """WITH q AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1),
       r AS (SELECT l_orderkey AS k, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
       SELECT o_orderkey AS orderkey, o_orderstatus, quantity, returned
       FROM orders LEFT JOIN q ON q.k = o_orderkey LEFT JOIN r ON r.k = o_orderkey""",
)
def join_all(spark, d):
    items = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    quantity = items.groupBy("orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    returned = items.where("l_returnflag = 'R'").groupBy("orderkey").agg(F.count(F.lit(1)).alias("returned"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    return jo.join_all([orders, quantity, returned], "orderkey", "left")


@query(
    "corpus_union",
    f"""WITH {inp.CONV} SELECT doc_id, text, lang, NULL::VARCHAR AS role FROM documents
        UNION ALL SELECT doc_id, text, NULL, role FROM conv""",
)
def corpus_union(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return jo.union_all([docs, inp.conversations(spark, d).select("doc_id", "text", "role")])


# ---- strings ----------------------------------------------------------------------


@query("title_case", f"SELECT doc_id, {inp.title_sql('text')} AS text FROM documents")
def title_case(spark, d):
    return inp.documents(spark, d).select("doc_id", fx.title_case("text").alias("text"))


@query(
    "titled_lines",
    f"WITH {inp.lines_sql('documents')} SELECT doc_id, line_no, {inp.title_sql('value')} AS value FROM lines"
    " WHERE length(value) >= 2",
)
def titled_lines(spark, d):
    return recipes.titled_lines(tk.document_lines(inp.documents(spark, d)))


@query("remove_eol", r"SELECT doc_id, translate(text, chr(10) || chr(13), '  ') AS text FROM documents")
def remove_eol(spark, d):
    return inp.documents(spark, d).select("doc_id", fx.remove_eol("text").alias("text"))


@query(
    "replace_map",
    r"""SELECT doc_id, regexp_replace(replace(replace(replace(text, '～', '~'), chr(10), ' '), chr(9), ' '),
        '(the|\.|\$)', '<$1', 'g') AS text FROM documents""",
)
def replace_map(spark, d):
    cleaned = fx.replace_map("text", {"～": "~", "\n": " ", "\t": " "})
    return inp.documents(spark, d).select(
        "doc_id", fx.replace_each(cleaned, ["the", ".", "$"], "<$1").alias("text")
    )


@query("rstrip_chars", "SELECT doc_id, rtrim(text, '.,!?&*%# ' || chr(10)) AS text FROM documents")
def rstrip_chars(spark, d):
    return inp.documents(spark, d).select("doc_id", fx.rstrip_chars("text", ".,!?&*%# \n").alias("text"))


@query("utf8_roundtrip", "SELECT doc_id, strlen(text) AS n_bytes, text FROM documents")
def utf8_roundtrip(spark, d):
    raw = inp.documents(spark, d).select("doc_id", fx.encode_utf8("text").alias("raw"))
    return raw.select("doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), fx.decode_utf8("raw").alias("text"))


@query(
    "remove_punc",
    f"SELECT doc_id, lower(regexp_replace(text, '[{ASCII_PUNCT}{CJK_PUNCT}{numeric_class()}]', '', 'g')) AS text"
    " FROM documents",
)
def remove_punc(spark, d):
    return inp.documents(spark, d).select("doc_id", fx.remove_punc("text").alias("text"))


@query("md5_hex", "SELECT doc_id, md5(text) AS digest FROM documents")
def md5_hex(spark, d):
    return inp.documents(spark, d).select("doc_id", fx.md5_hex("text").alias("digest"))


@query(
    "combine_columns",
    """SELECT p_partkey, p_size + p_retailprice AS total, p_brand || p_type || p_name AS words FROM part""",
)
def combine_columns(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        co.combine_columns(["p_size", "p_retailprice"]).alias("total"),
        co.combine_columns(["p_brand", "p_type", "p_name"], text=True).alias("words"),
    )


_WORDS = f"""terms AS (SELECT w AS word, count(*) AS tf, count(DISTINCT doc_id) AS df
  FROM (SELECT doc_id, unnest({inp.words_sql('text')}) AS w FROM documents) GROUP BY 1)"""
_WORD_POS = (
    "CASE WHEN length(word) % 2 = 0 THEN '词' ELSE '' END || word || '#' ||"
    " ['NN', 'NT', 'VV', 'NR'][length(word) % 4 + 1]"
)


@query(
    "pos_filter",
    f"""WITH {_WORDS}, tagged AS (SELECT {_WORD_POS} AS word_pos, CAST(tf AS DOUBLE) AS value FROM terms),
    stops AS (SELECT DISTINCT '词' || unnest({inp.words_sql('text')}) AS w FROM benchmark)
    SELECT word_pos, value FROM tagged WHERE regexp_matches(word_pos, '[一-\\x{{9FFF}}]') AND contains(word_pos, '#N')
    AND NOT contains(word_pos, '#NT') AND split_part(word_pos, '#', 1) NOT IN (SELECT w FROM stops)""",
)
def pos_filter(spark, d):
    terms = ag.term_frequencies(inp.documents(spark, d))
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("NN", "NT", "VV", "NR")]), F.length("word") % 4 + 1)
    word_pos = F.concat(F.when(F.length("word") % 2 == 0, "词").otherwise(""), "word", F.lit("#"), kinds)
    tagged = terms.select(word_pos.alias("word_pos"), F.col("tf").cast("double").alias("value"))
    stops = table(spark, d, "benchmark").select(F.explode(fx.words_of("text")).alias("w")).distinct()
    return co.clean_pos_table(tagged, stops.select(F.concat(F.lit("词"), "w").alias("word")))


@query(
    "lexical_words",
    f"""SELECT doc_id, array_to_string(list_transform(list_filter({inp.words_sql('text')},
        lambda w: ends_with(w, '###') OR ends_with(w, '***')), lambda w: split_part(w, '#', 1)), ' ') AS words
        FROM documents""",
)
def lexical_words(spark, d):
    words = co.lexical_words("text", ["###", "***"])
    return inp.documents(spark, d).select("doc_id", F.array_join(words, " ").alias("words"))


# ---- dates --------------------------------------------------------------------------


@query(
    "parse_time",
    """SELECT event_id, strftime(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '%Y-%m-%d %H:%M:%S.%f'),
       '%d/%m/%Y %H-%M-%S %f') AS parsed FROM events""",
)
def parse_time(spark, d):
    text = tm.format_time("ts", "%Y-%m-%d %H:%M:%S.%f")
    return table(spark, d, "events").select(
        "event_id", tm.format_time(tm.parse_time(text), "%d/%m/%Y %H-%M-%S %f").alias("parsed")
    )


@query("format_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def format_month(spark, d):
    return table(spark, d, "orders").select("o_orderkey", tm.format_time("o_orderdate").alias("month"))


@query(
    "trailing_week",
    """SELECT o_orderkey, (CAST(o_orderdate AS DATE) - 6 + CAST(i AS INTEGER))::VARCHAR AS day
       FROM orders, range(7) AS t(i)""",
)
def trailing_week(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.explode(tm.trailing_week("o_orderdate")).alias("day"))


@query("month_start", "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE::VARCHAR AS first FROM orders")
def month_start(spark, d):
    return table(spark, d, "orders").select("o_orderkey", tm.month_start("o_orderdate").cast("string").alias("first"))


@query(
    "last_month_days",
    """WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders)
       SELECT month::VARCHAR AS month, unnest(generate_series(month - INTERVAL 1 MONTH, month - INTERVAL 1 DAY,
       INTERVAL 1 DAY))::DATE::VARCHAR AS day FROM m""",
)
def last_month_days(spark, d):
    months = table(spark, d, "orders").select(tm.month_start("o_orderdate").alias("month")).distinct()
    return months.select(F.col("month").cast("string").alias("month"), F.explode(tm.last_month_days("month")).alias("day"))


@query(
    "time_range",
    """SELECT event_id, strftime(ts + CAST(i AS INTEGER) * INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS at
       FROM (SELECT event_id, date_trunc('hour', ts) AS ts FROM events), range(4) AS t(i)""",
)
def time_range(spark, d):
    quarters = table(spark, d, "events").select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    steps = F.filter(tm.time_range("ts", periods=60, freq="min"), lambda t: F.minute(t) % 15 == 0)
    return quarters.select("event_id", F.explode(steps).alias("at")).select(
        "event_id", tm.format_time("at", "%Y-%m-%d %H:%M:%S.%f").alias("at")
    )


@query(
    "pct_ratio",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount = 0 THEN NULL ELSE 100.0::DOUBLE * l_tax / l_discount END, 2)
       AS ratio FROM lineitem""",
)
def pct_ratio(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", co.pct_ratio("l_tax", "l_discount").alias("ratio")
    )


# ---- nested values ---------------------------------------------------------------------


@query("explode_pairs", "SELECT DISTINCT p_type AS kind, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_pairs(spark, d):
    words = table(spark, d, "part").select("p_type", F.split("p_name", " ").alias("words"))
    return co.explode_pairs(words, "p_type", "words", ["kind", "word"]).distinct()


@query(
    "flatten_cells",
    """SELECT unnest([p_brand, p_type, p_name, p_size::VARCHAR]) AS value FROM part""",
)
def flatten_cells(spark, d):
    return co.flatten_cells(table(spark, d, "part"), ["p_brand", "p_type", "p_name", "p_size"])


@query(
    "nested_names",
    """SELECT DISTINCT name FROM (SELECT unnest(list_append(string_split(p_name, ' '), p_brand || ' ' || p_name)) AS name
       FROM part WHERE p_type NOT IN ('SMALL', 'ECONOMY')) WHERE NOT contains(name, ' ')""",
)
def nested_names(spark, d):
    record = F.struct(
        F.col("p_type").alias("status"),
        F.concat(F.split("p_name", " "), F.array(F.concat("p_brand", F.lit(" "), "p_name"))).alias("acronyms"),
    )
    raw = table(spark, d, "part").select(F.to_json(F.struct(F.array(record).alias("institutes"))).alias("raw"))
    schema = "institutes ARRAY<STRUCT<status: STRING, acronyms: ARRAY<STRING>>>"
    return recipes.institute_acronyms(raw.select(F.from_json("raw", schema).alias("r")).select("r.*"), ["SMALL", "ECONOMY"])


@query(
    "company_names",
    "SELECT DISTINCT p_brand AS name FROM part WHERE NOT contains(p_brand, ' ')"
    " UNION SELECT DISTINCT p_type FROM part WHERE NOT contains(p_type, ' ')",
)
def company_names(spark, d):
    names = table(spark, d, "part").select(F.explode(F.array("p_brand", "p_type", "p_name")).alias("name"))
    raw = names.select(F.to_json(F.struct(F.struct(F.struct("name").alias("company_details")).alias("company_info"))).alias("raw"))
    schema = "company_info STRUCT<company_details: STRUCT<name: STRING>>"
    return recipes.company_names(raw.select(F.from_json("raw", schema).alias("r")).select("r.*"))


@query("recipe_names", f"SELECT p_type AS entity_types, {inp.title_sql('p_name')} AS entity_names FROM part")
def recipe_names(spark, d):
    raw = table(spark, d, "part").select(F.col("p_type").alias("category"), F.col("p_name").alias("nname_en"))
    return recipes.titled_names(raw)


# ---- global order ----------------------------------------------------------------------


@query(
    "split_evenly",
    "SELECT o_orderkey, (ntile(7) OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1)::INTEGER AS piece FROM orders",
)
def split_evenly(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rk.split_evenly(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 7).drop("o_totalprice")


@query(
    "decile_points",
    """WITH r AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS p, value, count(*) OVER () AS n,
         max(value) OVER () AS m FROM events),
       picked AS (SELECT p AS position, value, n, m FROM r WHERE p % CASE WHEN n < 11 THEN 1 ELSE n // 10 END = 0)
       SELECT position, value FROM picked UNION ALL
       SELECT n, m FROM (SELECT * FROM picked ORDER BY position DESC LIMIT 1) WHERE value <> m AND n >= 11""",
)
def decile_points(spark, d):
    return rk.decile_points(table(spark, d, "events"), "value", ["event_id"])


@query(
    "top_fraction",
    """SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS r,
       count(*) OVER () AS n FROM orders) WHERE r <= floor(n * 0.1)""",
)
def top_fraction(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rk.top_fraction(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 0.1)


@query(
    "slice_rows",
    """SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders)
       WHERE r >= 100 AND r < 1200""",
)
def slice_rows(spark, d):
    return rk.slice_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100, 1200)


@query(
    "sample_rows",
    """SELECT doc_id, lang FROM documents ORDER BY md5(doc_id::VARCHAR || '#7'), doc_id LIMIT 50""",
)
def sample_rows(spark, d):
    return rk.sample_rows(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 50, seed=7)


@query(
    "group_list",
    """SELECT user_id, chunk, string_agg(event_type, ',' ORDER BY event_id) AS events FROM (SELECT *,
       ((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 50)::INTEGER AS chunk FROM events)
       GROUP BY 1, 2""",
)
def group_list(spark, d):
    lists = rk.group_to_list(table(spark, d, "events"), "user_id", "event_type", ["event_id"], chunk_rows=50)
    return lists.select("user_id", "chunk", F.array_join("values", ",").alias("events"))


@query("last_per_key", "SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def last_per_key(spark, d):
    return ag.last_per_key(table(spark, d, "events"), "user_id", "event_type", "event_id")


@query(
    "distinct_values",
    f"SELECT DISTINCT {inp.title_sql('v')} AS value FROM (SELECT unnest([p_brand, p_type, p_name]) AS v FROM part)",
)
def distinct_values(spark, d):
    return ag.distinct_values(table(spark, d, "part"), ["p_brand", "p_type", "p_name"], title=True)


@query(
    "brand_entropy",
    """WITH w AS (SELECT event_id, event_type AS brand, user_id AS topic, CAST(json_extract(props, '$.k') AS INTEGER) % 10
         AS dimension, CAST(floor(value) AS BIGINT) AS weight FROM events),
       b AS (SELECT topic, dimension, brand, sum(weight) AS s, arg_max(weight, event_id) AS l FROM w GROUP BY 1, 2, 3),
       t AS (SELECT *, sum(s) OVER (PARTITION BY topic, dimension) AS total FROM b)
       SELECT topic, dimension, CAST(max(total) AS BIGINT) AS total,
         round(coalesce(-sum(CASE WHEN l > 0 THEN (l::DOUBLE / total) * ln(l::DOUBLE / total) ELSE 0 END), 0), 6)
         + 0.0 AS entropy FROM t GROUP BY 1, 2""",
)
def brand_entropy(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("brand"), F.col("user_id").alias("topic"),
        (F.from_json("props", "k INT")["k"] % 10).alias("dimension"), F.floor("value").alias("weight"),
    )
    entropy = ag.grouped_entropy(rows, ["topic", "dimension"], "brand", "weight", "event_id")
    return entropy.withColumn("entropy", F.round("entropy", 6) + F.lit(0.0))


@query(
    "label_entropy",
    """SELECT round(-sum(p * log2(p)), 6) AS entropy FROM (SELECT count(*) / sum(count(*)) OVER () AS p
       FROM documents GROUP BY lang)""",
)
def label_entropy(spark, d):
    return ag.label_entropy(table(spark, d, "documents"), "lang").select(F.round("entropy", 6).alias("entropy"))


@query(
    "recipe_news",
    rf"""WITH news AS (SELECT doc_id, replace(replace(text, chr(10), ' '), chr(9), ' ') AS text FROM documents
          WHERE text IS NOT NULL ORDER BY md5(doc_id::VARCHAR || '#3'), doc_id LIMIT 40),
         {inp.tokens_sql('news')} SELECT doc_id, sent_id, tok_id, token FROM toks""",
)
def recipe_news(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return recipes.news_tokens(docs, k=40, seed=3)


@query(
    "ner_candidates",
    rf"""WITH {inp.sentences_sql('documents')} SELECT doc_id, sent_id, sentence FROM sents
        WHERE len(list_filter(string_split(sentence, ' '), lambda w: {inp.alnum_sql('w')}
        AND NOT (w = lower(w) AND w <> upper(w)))) > 2""",
)
def ner_candidates(spark, d):
    return tk.ner_candidates(tk.document_sentences(inp.documents(spark, d)))


# ---- chunks of files and sketches ------------------------------------------------


@query(
    "chunked_files",
    """SELECT ((r - 1) // 3000)::INTEGER AS file, count(*) AS n_rows, sum(event_id)::BIGINT AS ids, min(event_id) AS least, max(event_id) AS largest
       FROM (SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS r FROM events) GROUP BY 1""",
)
def chunked_files(spark, d):
    """Files of 3000 rows each, read back and numbered by name."""
    events, path = table(spark, d, "events").select("event_id", "user_id", "value"), work_folder(spark, "chunks")
    write_chunked(events, path, 3000, order=[F.col("value").desc(), "event_id"])
    found = spark.read.option("header", True).schema("event_id long, user_id long, value double").csv(path)
    named = found.withColumn("name", F.input_file_name())
    ids = [F.sum("event_id").alias("ids"), F.min("event_id").alias("least"), F.max("event_id").alias("largest")]
    by_file = named.groupBy("name").agg(F.count("*").alias("n_rows"), *ids)
    return rk.with_rank(by_file, ["name"], "file").select(F.col("file").cast("int").alias("file"), "n_rows", "ids", "least", "largest")


SKETCH_POINTS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query(
    "approx_quantiles",
    f"""SELECT o_orderpriority, point, count(*) AS n, true AS near FROM orders, (SELECT unnest({SKETCH_POINTS}::DOUBLE[]) AS point)
        WHERE o_totalprice IS NOT NULL GROUP BY 1, 2""",
)
def approx_quantiles(spark, d):
    """Whether quantiles of merged sketches have the rank they should, within three times the error asked for."""
    error, key = 0.01, "o_orderpriority"
    orders = table(spark, d, "orders")
    by_month = rk.quantile_sketches(orders.withColumn("month", F.month("o_orderdate")), "o_totalprice", error, [key, "month"])
    found = rk.sketched_quantiles(rk.merge_sketches(by_month, [key]), SKETCH_POINTS, [key])
    points = F.array(*[F.struct(F.lit(p).alias("point"), F.col(f"q{i}").alias("q")) for i, p in enumerate(SKETCH_POINTS)])
    asked = found.select(key, F.explode(points).alias("a")).select(key, "a.*")
    priced = orders.where("o_totalprice IS NOT NULL").select(key, "o_totalprice")
    rank = F.avg(F.when(F.col("o_totalprice") <= F.col("q"), 1.0).otherwise(0.0))
    ranked = priced.join(asked, key).groupBy(key, "point").agg(F.count("*").alias("n"), rank.alias("rank"))
    return ranked.select(key, "point", "n", (F.abs(F.col("rank") - F.col("point")) <= 3 * error).alias("near"))
