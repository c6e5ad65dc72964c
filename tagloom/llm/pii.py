"""Personal data by bootstrapped contextual extraction, with DataFrame functions alone.

1. *Seeds.* Four fixed patterns with checks (octets, Luhn digit, number of digits) find email addresses, IP addresses, card
   and phone numbers with their places. These always stay.
2. *Candidates.* Looser shapes of the same four kinds are located where no seed lies. They have checks of their own: the Luhn
   digit for cards and the number of digits for phones; IPv6 addresses and written-out email addresses are whole by shape.
3. *Patterns.* The two words before a seed or candidate are its lexical pattern. Spark keeps the graph of patterns and
   instances (the strings) as rows ``kind, pattern, instance, places``, and scores it in rounds: a pattern's score is the
   share of its places whose instance is believed, an instance's score is that of the best pattern that has enough
   believed instances behind it. Instances found in one round support patterns in the next.
4. *Extraction.* Candidates whose instance passes the threshold become spans beside the base ones.

Only what was located is stored and shuffled, never the texts. All groupings combine before they shuffle.

Patterns are written so that Java's matcher neither recurses nor looks at a run of characters twice.

Defined cases: null and empty texts have no spans; rows that repeat are searched each; a text is never cut; candidates
without two words before them are not judged; an empty table gives no rows. Columns beyond the two named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import stored

KINDS = ["email", "ip", "card", "phone"]
#: Fixed patterns. Possessive, and started where a run starts or right behind the match before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]++){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./])[0-9]{4}(?:([./])[0-9]{4})\1[0-9]{4}\1[0-9]{4}(?![0-9./])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
#: What a text must hold before a pattern is tried at all.
NEEDS = {"email": "@", "phone": "+"}
LOOSE_NEEDS = {"email": "at", "ip": ":"}
ROUNDS = 3
#: A pattern counts from so many different believed instances on, and from this share of its places on.
LEAST_INSTANCES = 5
LEAST_SCORE = 0.8
_TAIL = 80


def _matches(text: Column, pattern: str, need: str | None) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    return F.when(F.contains(text, F.lit(need)), found).otherwise(none) if need else found


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    size = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, size - i + 1, F.lit(1))) - 48
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    right = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), step) % 10 == 0
    return size.between(13, 19) & right


def _octets(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(match, r"\."), small)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return _octets(match)
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _valid_loose(kind: str, match: Column) -> Column:
    """As :func:`_valid` for loose shapes, whose addresses are IPv6 and have no octets."""
    return F.lit(True) if kind == "ip" else _valid(kind, match)


def _check(kind: str, valid: Callable[[str, Column], Column]):
    return lambda x: valid(kind, x["instance"])


def _placed(pieces: str, found: str) -> Column:
    """``start, end, instance, before`` of matches, from the pieces between them; ends are exclusive, in code points."""
    empty = F.expr("cast(array() as array<struct<start:int,end:int,instance:string,before:string>>)")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        before = F.when(F.length(x["piece"]) > _TAIL, F.right(x["piece"], F.lit(_TAIL))).otherwise(x["piece"])
        one = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("instance"), before.alias("before"))
        return F.struct(end.alias("at"), F.concat(state["list"], F.array(one)).alias("list"))

    zipped = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    scan = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("list")), step, lambda s: s["list"])
    return F.when(F.size(found) > 0, scan).otherwise(empty)


def _located(rows: DataFrame, patterns: dict[str, str], needs: dict[str, str], valid: Callable[[str, Column], Column], prefix: str) -> DataFrame:
    """Adds a column ``{prefix}_{kind}`` of places for each kind, those that pass its check."""
    found = rows.withColumns({f"f_{k}": _matches(F.col("text"), p, needs.get(k)) for k, p in patterns.items()})
    cut = found.withColumns(
        {f"p_{k}": F.when(F.size(f"f_{k}") > 0, F.split("text", p, -1)).otherwise(F.array().cast("array<string>")) for k, p in patterns.items()}
    )
    placed = cut.withColumns({f"{prefix}_{k}": F.filter(_placed(f"p_{k}", f"f_{k}"), _check(k, valid)) for k in patterns})
    return placed.drop(*[f"{x}_{k}" for x in "fp" for k in patterns])


def locate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id`` and the places ``base_*`` and ``loose_*`` of every row; stored, so ``row`` is fixed."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    placed = _located(_located(rows, BASE, NEEDS, _valid, "base"), LOOSE, LOOSE_NEEDS, _valid_loose, "loose")
    apart = {
        f"loose_{k}": F.filter(
            f"loose_{k}", lambda x: ~F.exists(F.concat(*[f"base_{b}" for b in KINDS]), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        )
        for k in KINDS
    }
    return stored(placed.withColumns(apart).drop("text").withColumn("row", F.monotonically_increasing_id()), "places")


def _occurrences(places: DataFrame, prefix: str, seed: bool) -> DataFrame:
    def named(kind: str) -> Column:
        fields = ["start", "end", "instance", "before"]
        return F.transform(f"{prefix}_{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), *[x[f].alias(f) for f in fields]))

    tagged = [named(k) for k in KINDS]
    rows = places.select("row", F.explode(F.concat(*tagged)).alias("x")).select("row", "x.*")
    words = F.regexp_extract(F.lower("before"), r"(\S+\s+\S+)\s*$", 1)
    pattern = F.regexp_replace(F.regexp_replace(words, r"[0-9]", "9"), r"\s+", " ")
    return rows.withColumn("pattern", pattern).withColumn("seed", F.lit(seed)).drop("before")


def believed_instances(places: DataFrame, rounds: int = ROUNDS, least: int = LEAST_INSTANCES, score: float = LEAST_SCORE) -> DataFrame:
    """``kind, instance`` of the candidates that patterns support, after ``rounds`` of scoring the graph."""
    seen = _occurrences(places, "base", True).unionByName(_occurrences(places, "loose", False)).where("pattern <> ''")
    graph = seen.groupBy("kind", "pattern", "instance").agg(F.count("*").alias("places"), F.max("seed").alias("seed"))
    graph = stored(graph.withColumn("score", F.col("seed").cast("double")), "graph")
    for _ in range(rounds):
        # duplicates of an instance count once for support, each place counts for the share
        patterns = graph.groupBy("kind", "pattern").agg(
            F.sum(F.when(F.col("score") >= score, 1).otherwise(0)).alias("believed"),
            (F.sum(F.col("score") * F.col("places")) / F.sum("places")).alias("strength"),
        ).where((F.col("believed") >= least) & (F.col("strength") >= score))
        best = graph.where(~F.col("seed")).join(patterns, ["kind", "pattern"]).groupBy("kind", "instance").agg(F.max("strength").alias("found"))
        graph = stored(
            graph.join(best, ["kind", "instance"], "left")
            .withColumn("score", F.greatest("score", F.coalesce("found", F.lit(0.0)))).drop("found"), "graph",
        )
    return graph.where(~F.col("seed") & (F.col("score") >= score)).select("kind", "instance").distinct()


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _by_kind(prefix: str) -> Column:
    def ordered(i: int, kind: str) -> Column:
        return F.transform(f"{prefix}_{kind}", lambda x: F.struct(F.lit(i).alias("order"), x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.concat(*[ordered(i, k) for i, k in enumerate(KINDS)])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256, spans, n_added`` for every row."""
    places = locate(docs, id_col, text_col)
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    added = (
        _occurrences(places, "loose", False).join(believed_instances(places), ["kind", "instance"])
        .groupBy("row").agg(F.collect_list(F.struct(order[F.col("kind")].alias("order"), "start", "end", "kind")).alias("added"))
    )
    none = F.array().cast("array<struct<order:int,start:int,end:int,kind:string>>")
    rows = places.withColumn("base", _by_kind("base")).join(added, "row", "left").withColumn("added", F.coalesce("added", none))
    counts = [F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(
        "doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
