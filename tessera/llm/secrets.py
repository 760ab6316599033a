"""Secret scan, in DataFrame operations only: fixed patterns, then character
Markov models.

Three patterns give the base spans. Other long tokens are compared under two
first-order character models, one of random strings and one of ordinary
identifiers, by the log-likelihood ratio of their transitions. The models are
trained on labelled samples. Random strings are digests of numbers, written in
the three forms that keys take (:func:`random_samples`, a set of fixed size that
no document changes), and the documents' own hexadecimal and access keys;
free-form values after ``password=`` are no sample. Each form has a model of its
own, and a token goes by the one that fits best. Identifiers are all the documents' long
tokens of letters. Only the transition counts (at most 6 x 67 x 67 numbers) come
back to the driver. A token of one class of characters (digits alone, as card
numbers, or letters of one case) is never added.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.scratch import Scratch

#: The base kinds in order, with their patterns (fixed values of the contract).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the same spans as AKIA[A-Z0-9]+ with 16 characters or more
HEX = r"[0-9a-f]{32,}"  # the same spans as [0-9a-f]+ with 32 characters or more
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_VALUE = 8

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"
#: Tokens that the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = r"^[A-Za-z]+(?:[_-][A-Za-z]+)*$"
#: Log odds that a token must reach (a random string is rare beforehand).
MARGIN = log(1000)
#: Numbers whose digests are the fixed samples of random strings.
SAMPLES = 4096
_SMOOTH = 0.5
_MARKOV = 3


def _found(text: Column, kind: int, pattern: str, guard: Column | None) -> Column:
    """(kind, i, gap, match) of each match: gap is the length of the text between
    it and the match before."""
    none = F.array().cast("array<string>")
    matches, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    if guard is not None:
        matches, between = F.when(guard, matches).otherwise(none), F.when(guard, between).otherwise(none)
    zipped = F.filter(F.arrays_zip(matches.alias("m"), between.alias("g")), lambda x: x["m"].isNotNull())
    return F.transform(zipped, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), x["m"].alias("match")))


def _tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, start, end, value, clear) of base spans and of tokens; clear
    is false for tokens that overlap a base span."""
    text = F.col("text")
    low = F.lower(text)
    assign = F.contains(low, F.lit("passw")) | F.contains(low, F.lit("secret")) | F.contains(low, F.lit("token")) | F.contains(low, F.lit("api"))
    found = F.concat(
        _found(text, 0, ASSIGN, assign),
        _found(text, 1, ACCESS, F.contains(text, F.lit("AKIA"))),
        _found(text, 2, HEX, F.rlike(text, F.lit("[0-9a-f]{32}"))),
        _found(text, _MARKOV, TOKEN, None),
    )
    rows = docs.select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.kind", "f.i", "f.gap", "f.match")
    rows = rows.withColumn("length", F.length("match")).repartition("doc_id").distinct()
    order = Window.partitionBy("doc_id", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("length")).over(order)
    value = F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    rows = rows.select("doc_id", "kind", (end - F.col("length")).alias("start"), end.alias("end"), value.alias("value"))
    rows = rows.where((F.col("kind") != 0) | (F.length("value") >= ASSIGN_VALUE))
    place = Window.partitionBy("doc_id").orderBy("start", "kind")
    base = F.col("kind") < _MARKOV
    before = F.max(F.when(base, F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(base, F.col("start"))).over(place.rowsBetween(0, Window.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    return rows.withColumn("clear", clear)


def random_samples(spark: SparkSession, n: int = SAMPLES) -> DataFrame:
    """(kind, value, clear): ``3 n`` strings labelled random, the digests of 0 to
    n-1 in base 64 (kind 0, in place of assigned values), in capitals and digits
    (as access keys) and in hexadecimal."""
    number = F.col("id").cast("string").cast("binary")
    capitals = [F.conv(F.substring(F.sha2(number, 224), at, F.lit(15)), 16, 36) for at in (F.lit(1), F.lit(16))]
    forms = F.array(F.base64(F.unhex(F.sha2(number, 384))), F.concat(*capitals), F.sha2(number, 256))
    return spark.range(n).select(F.posexplode(forms).alias("kind", "value"), F.lit(True).alias("clear"))


def several_classes(value: Column) -> Column:
    """Whether two or more of a-z, A-Z and 0-9 occur."""
    has = [F.rlike(value, F.lit(c)).cast("int") for c in ("[a-z]", "[A-Z]", "[0-9]")]
    return has[0] + has[1] + has[2] > 1


def train(tokens: DataFrame) -> list[float] | None:
    """Log-likelihood ratios, random over identifier, of each pair of characters
    (row by row over :data:`ALPHABET`); None without samples of both labels."""
    label = F.when(F.col("kind") < _MARKOV, 0).when(F.col("clear") & F.rlike("value", F.lit(IDENTIFIER)), 1)
    samples = tokens.select(label.alias("label"), "value").where("label is not null and length(value) > 1")
    pairs = F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring(F.col("value"), i, F.lit(2)))
    counts = samples.select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").agg(F.count("*").alias("n"))
    size = len(ALPHABET)
    table = [[[_SMOOTH] * size for _ in range(size)] for _ in range(2)]
    seen = set()
    for r in counts.collect():  # at most 2 x 67 x 67 rows
        a, b = (ALPHABET.index(c) for c in r["pair"])
        table[r["label"]][a][b] += r["n"]
        seen.add(r["label"])
    if seen != {0, 1}:
        return None
    return [log(p / sum(r)) - log(q / sum(s)) for r, s in zip(*table) for p, q in zip(r, s)]


def likelihood_ratio(value: Column, ratios: list[float]) -> Column:
    """Sum of the ratios of a token's transitions."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # a constant to the planner

    def at(i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1))) - 1

    steps = F.sequence(F.lit(1), F.length(value) - 1)
    return F.aggregate(steps, F.lit(0.0), lambda s, i: s + F.get(table, at(i) * len(ALPHABET) + at(i + 1)))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (all, by start and then kind:
    kind, start, end in code points, end exclusive), n_assign, n_access, n_hex.

    Null and empty texts have none; whole texts are scanned. Spans of one kind
    don't overlap; Markov spans overlap none of the others, and there are none
    where the documents hold no identifier to learn from. doc_id is distinct but for
    repeated rows, which each get the result; rows without one have no spans. Other columns are ignored. An empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        tokens = scratch.table(_tokens(source.where("doc_id is not null")), "tokens")
        keys = tokens.where("kind <> 0").select("kind", "value", "clear")
        samples = keys.unionByName(random_samples(docs.sparkSession))
        models = [train(samples.where(F.col("kind").isin(form, _MARKOV))) for form in range(_MARKOV)]
        wanted = F.col("kind") < _MARKOV
        if all(models):
            best = F.greatest(*[likelihood_ratio(F.col("value"), ratios) for ratios in models])
            wanted = wanted | (F.col("clear") & several_classes(F.col("value")) & (best >= MARGIN))
        span = F.struct("start", "kind", "end")
        counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(_MARKOV)]
        spans = tokens.where(wanted).groupBy("doc_id").agg(F.sort_array(F.collect_list(span)).alias("found"), *counts)
        spans = scratch.keep(spans, "secrets")
    kind = F.array(*map(F.lit, KINDS))
    named = F.transform("found", lambda s: F.struct(F.get(kind, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"))
        .join(spans, "doc_id", "left")
        .select("doc_id", F.coalesce(named, none).alias("spans"), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:_MARKOV]])
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != KINDS[_MARKOV])
