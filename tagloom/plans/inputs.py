"""Token tables that queries derive from the given tables, in Spark and in SQL.

The data has no annotated tags, so tags are a rule on the ordinals of a token
that both engines can state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import constants as C
from tagloom.operators.sequences import with_fields
from tagloom.operators.tokens import char_bilou, document_lines, sentence_tokens
from tagloom.plans.registry import table
from tagloom.session import spread

S = C.SPACE
TURNS = 1 << 20  # turns per conversation that one key leaves room for


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = spread(table(spark, folder, "conversations"))
    return turns.withColumn("doc_id", F.col("conv_id") * TURNS + F.col("turn"))


# ``packed`` gives sentence tables, whose shuffle moves texts and not tokens.


def conversation_tokens(spark: SparkSession, folder: str, packed: bool = False) -> DataFrame:
    return sentence_tokens(conversations(spark, folder), packed=packed)


def document_tokens(spark: SparkSession, folder: str, packed: bool = False) -> DataFrame:
    return sentence_tokens(documents(spark, folder), packed=packed)


def _dealt(texts: DataFrame, splits: int) -> DataFrame:
    """Texts dealt out by document, so that grouping their tokens by sentence moves none.

    There are more partitions with more splits, so that a task sorts its tokens in memory at any size.
    """
    return texts.repartition(max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * splits), "doc_id")


def dealt_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The token rows of documents whose texts were dealt out by document."""
    texts = table(spark, folder, "documents")
    return sentence_tokens(_dealt(texts, texts.rdd.getNumPartitions()))


def dealt_conversation_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The token rows of conversations whose texts were dealt out by turn.

    Turns without a number share a key; their tokens meet in the order in which :func:`conversation_tokens` has them.
    """
    splits = table(spark, folder, "conversations").rdd.getNumPartitions()
    return sentence_tokens(_dealt(conversations(spark, folder), splits))


def conversation_chars(spark: SparkSession, folder: str, packed: bool = False) -> DataFrame:
    return char_bilou(document_lines(conversations(spark, folder)), packed=packed)


def document_chars(spark: SparkSession, folder: str, packed: bool = False) -> DataFrame:
    return char_bilou(document_lines(documents(spark, folder)), packed=packed)


# ---- tags by rule -------------------------------------------------------------

IOB_CYCLE = ["B-PER", "O", "B-ORG", "I-ORG", "O", "B-LOC", "B-MISC", "I-MISC", "O", "O"]
BILOU_CYCLE = ["B-COM", "L-COM", "O", "U-PPL", "O", "B-PPL", "I-PPL", "L-PPL", "O", "U-GPE", "O"]


def _pick(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))


def _pick_sql(values: list[str], at: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][(({at}) % {len(values)}) + 1]"


def _mix(a: int, b: int, c: int, get: Callable[[str], Column] = F.col) -> Column:
    return get("doc_id") * a + get("sent_id") * b + get("tok_id") * c


def with_iob(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("ner", _pick(IOB_CYCLE, _mix(1, 3, 1)))


def with_truth(tokens: DataFrame, out: str = "truth") -> DataFrame:
    return with_fields(tokens, {out: lambda get: _pick(BILOU_CYCLE, _mix(1, 3, 1, get))})


def with_prediction(tokens: DataFrame) -> DataFrame:
    """Add ``truth`` and a ``pred`` that is wrong on two of seventeen residues."""
    def pred(get: Callable[[str], Column]) -> Column:
        rule = F.pmod(_mix(7, 5, 3, get), F.lit(17))
        return F.when(rule == 0, "O").when(rule == 5, "U-COM").otherwise(get("truth"))

    return with_fields(with_truth(tokens), {"pred": pred})


def model_tags(tokens: DataFrame, names: list[str]) -> DataFrame:
    """One tag column per model name: the rule tags shifted by the model's place."""
    return tokens.withColumns({n: _pick(BILOU_CYCLE, _mix(1, 3, 1) + i * (F.pmod(_mix(5, 1, 2), F.lit(3)))) for i, n in enumerate(names)})


def perturbed_chars(chars: DataFrame) -> DataFrame:
    """Character tags of which one in seventeen is replaced, so that words break and merge."""
    def tag(get: Callable[[str], Column]) -> Column:
        rule = F.pmod(_mix(7, 5, 3, get), F.lit(17))
        return F.when(rule == 0, "I-w").when(rule == 5, "U-w").otherwise(get("ner"))

    return with_fields(chars, {"ner": tag})


# ---- the same in SQL ----------------------------------------------------------

MIX = "doc_id + sent_id * 3 + tok_id"
RULE = "(doc_id * 7 + sent_id * 5 + tok_id * 3) % 17"
IOB_SQL = _pick_sql(IOB_CYCLE, MIX)
TRUTH_SQL = _pick_sql(BILOU_CYCLE, MIX)
PRED_SQL = f"CASE WHEN {RULE} = 0 THEN 'O' WHEN {RULE} = 5 THEN 'U-COM' ELSE truth END"


def model_tag_sql(i: int) -> str:
    return _pick_sql(BILOU_CYCLE, f"{MIX} + {i} * ((doc_id * 5 + sent_id + tok_id * 2) % 3)")


CONV = f"conv AS (SELECT conv_id * {TURNS} + turn AS doc_id, role, text FROM conversations)"
DOCS = "docs AS (SELECT doc_id, lang, text FROM documents)"


def words_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[{S}]+'), lambda w: w <> '')"


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '^[{S}]+|[{S}]+$', '', 'g')"


def alnum_sql(word: str) -> str:
    return rf"regexp_matches({word}, '^[\p{{L}}\p{{N}}]+$')"


def lines_sql(source: str) -> str:
    """CTE ``lines`` (doc_id, line_no, value)."""
    return (
        "lines AS (SELECT * FROM (SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS line_no, unnest(l) AS value"
        rf" FROM (SELECT doc_id, regexp_split_to_array(text, '{C.LINE_BREAK}') AS l FROM {source}))"
        rf" WHERE regexp_matches(value, '[^{S}]'))"
    )


def sentences_sql(source: str) -> str:
    """CTE ``sents`` (doc_id, sent_id, sentence)."""
    cut = rf"regexp_replace(text, '([{C.SENTENCE_END}])[{S}]+|\n', '\1' || chr(1), 'g')"
    return (
        "sents AS (SELECT * FROM (SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS sent_id,"
        f" unnest(l) AS sentence FROM (SELECT doc_id, string_split({cut}, chr(1)) AS l FROM {source}"
        rf" WHERE text <> '\N')) WHERE regexp_matches(sentence, '[^{S}]'))"
    )


def tokens_sql(source: str) -> str:
    """CTEs ``sents`` and ``toks`` (doc_id, sent_id, tok_id, token)."""
    return (
        f"{sentences_sql(source)}, toks AS (SELECT doc_id, sent_id,"
        " (generate_subscripts(l, 1) - 1)::INTEGER AS tok_id, unnest(l) AS token"
        f" FROM (SELECT doc_id, sent_id, regexp_extract_all(sentence, '{C.TOKEN_PATTERN}') AS l FROM sents))"
    )


def chars_sql(source: str) -> str:
    """CTEs ``lines`` and ``chars`` (doc_id, sent_id, tok_id, token, ner), word by word."""
    return f"""{lines_sql(source)},
words AS (SELECT doc_id, line_no, generate_subscripts(l, 1) AS k, unnest(l) AS w
  FROM (SELECT doc_id, line_no, string_split({strip_sql('value')}, ' ') AS l FROM lines)),
placed AS (SELECT *, coalesce(sum(length(w) + 1) OVER (PARTITION BY doc_id, line_no ORDER BY k
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM words),
spelt AS (SELECT *, length(w) AS n, unnest(range(1, length(w) + 1)) AS i FROM placed WHERE w <> ''),
chars AS (SELECT doc_id, line_no AS sent_id, (off + i - 1)::INTEGER AS tok_id, substr(w, i, 1) AS token,
  CASE WHEN n = 1 AND regexp_matches(w, '^[{C.PUNCT}]$') THEN 'O' WHEN n = 1 THEN 'U-w' WHEN i = 1 THEN 'B-w'
  WHEN i = n THEN 'L-w' ELSE 'I-w' END AS ner FROM spelt)"""


def title_sql(text: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({text}, '[{C.CASED}]+|[^{C.CASED}]+'),"
        " lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])), '')"
    )


TRUTH_TOKENS = f"truths AS (SELECT *, {TRUTH_SQL} AS truth FROM toks)"
PRED_TOKENS = f"{TRUTH_TOKENS}, preds AS (SELECT *, {PRED_SQL} AS pred FROM truths)"
CONV_TOKENS = f"{CONV}, {tokens_sql('conv')}"
DOC_TOKENS = tokens_sql("documents")
CONV_CHARS = f"{CONV}, {chars_sql('conv')}"
DOC_CHARS = chars_sql("documents")
