"""Secret scan with a random forest that removes false positives (DataFrame and ML functions only).

Candidates are runs of 16 or more key characters that hold a digit ('=' only
ends them), and any value assigned to a name with a key word among its parts
(client_secret, accessToken, "api-key", bearer), quoted or not, of any length,
with the text before and after. The forest's features: length, shares of
character classes, character transitions, distinct characters, dictionary
coverage (letter trigrams that are common in prose), path context and the
neighbouring words (key-like word, assignment, quotes, and how often findings
after the same word were real). It is trained from labelled findings.

Bounds: the forest is fitted on at most FIT_PER_CLASS labelled findings of
each class, those with the smallest hash. The dictionary counts the words of
all texts, first in each task. Candidates are taken from whole texts of all
rows.

Edge cases: null and empty texts have no candidates; without findings of both
classes nothing can be learned and every candidate stays, with a null score;
equal rows give equal findings of their own; a null id stays null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.llm.common import cut

# A run of key characters with a digit, '=' at its end only; nothing is tried twice at one place.
RUN = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{16,}+={0,2}"
# Parts of a name that make its value a key's.
KEY_WORD = (r"(?:^|[^a-z])(?:[a-z]*(?:token|secret|password|passwd|passphrase|pwd|credential|apikey|accesskey|secretkey|privatekey)"
            r"|key|auth|authorization|bearer|private|pass)s?(?:[^a-z]|$)")
_ASSIGN = r"""["'\]]{0,2}[ \t]{0,8}(?:=>|:=|[=:])[ \t]{0,8}["'`]?"""
_BEARER = r"""bearer[ \t]{1,8}["'`]?"""
# Directly after an assignment to a name that may be a key's (cheap look first; KEY_WORD decides).
_KEYED = (r"""(?<=[=:>][ \t]{0,8}["'`]?|[Rr][ \t]{1,8}["'`]?)(?<=(?i:(?:token|secret|passw|passphrase|pwd|credential|key|auth|private|pass|bearer)[\w.\-]{0,24}"""
          + _ASSIGN + "|" + _BEARER + r"))(?!(?i:bearer)[ \t])")
_QUOTED = r"""(?<=["'`])[^"'`\r\n]++(?=["'`])"""
_BARE = r"""[^\s"'`,;<>(){}\[\]&=:.][^\s"'`,;<>(){}\[\]&=.]*+(?:\.[^\s"'`,;<>(){}\[\]&=.]++)*+={0,2}"""
CANDIDATE = f"{_KEYED}(?:{_QUOTED}|{_BARE})|{RUN}"
CONTEXT = 64
FIT_PER_CLASS = 4000
# A trigram of prose has this share of all trigrams, and so many places at least.
DICTIONARY_SHARE, DICTIONARY_LEAST = 1e-4, 20
PLACEHOLDER = r"(?i)^(?:none|null|nil|true|false|undefined|changeme|example|todo|(.)\1*|\$.*|%.*%|.*\byour\b.*|.*your[_-].*)$"
FILE_PATH = r"^/?[a-z0-9_.\-]+(?:/[a-z0-9_.\-]+)+$"
TREES, DEPTH, SEED = 24, 6, 7
FEATURES = ["length", "digits", "uppers", "lowers", "transitions", "distinct", "coverage", "in_path", "slashes",
            "key_word", "assigned", "quoted", "word_rate"]


def candidates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, value, before, after): all candidates, start counted in characters from 0."""
    t = F.col(text).cast("string")
    d = documents.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("text")).filter(F.col("text").rlike(CANDIDATE))
    d = d.select("doc_id", F.monotonically_increasing_id().alias("row"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
                 F.split("text", CANDIDATE, -1).alias("parts"))
    parts = F.transform("parts", lambda p: F.struct(F.length(p).alias("n"), F.substring(p, 1, CONTEXT).alias("head"),
                                                    F.substring(p, -CONTEXT, CONTEXT).alias("tail")))
    d = d.withColumn("parts", parts)
    one = F.arrays_zip("found", F.col("parts").alias("left"), F.slice("parts", F.lit(2), F.size("found")).alias("right"))
    d = d.select("doc_id", "row", F.posexplode(F.slice(one, F.lit(1), F.size("found"))).alias("i", "c"))
    d = d.select("doc_id", "row", "i", F.col("c.found").alias("value"), F.col("c.left.n").alias("gap"), F.col("c.left.tail").alias("tail"),
                 F.col("c.left.n").alias("left_n"), F.col("c.left.head").alias("head"), F.col("c.right.head").alias("after"))
    before = F.when(F.col("left_n") <= CONTEXT, F.col("head")).otherwise(F.col("tail"))
    upto = Window.partitionBy("row").orderBy("i")
    start = F.sum(F.col("gap") + F.length("value")).over(upto) - F.length("value")
    d = d.select("doc_id", start.alias("start"), "value", before.alias("before"), "after")
    return d.filter(F.col("value").rlike(f"^(?:{RUN})$") | _key_word(_name(F.col("before"))))


def _name(before: Column) -> Column:
    """The name assigned to, or else the last word, lower-cased and its humps parted."""
    given = F.regexp_extract(before, rf"([\p{{L}}\p{{N}}_.\-]+){_ASSIGN}$", 1)
    last = F.regexp_extract(before, r"([\p{L}_]+)[^\p{L}_]*$", 1)
    return F.lower(F.regexp_replace(F.when(given != "", given).otherwise(last), r"(?<=[a-z0-9])(?=[A-Z])", "_"))


def _key_word(name: Column) -> Column:
    return name.rlike(KEY_WORD)


def dictionary(documents: DataFrame, text: str = "text") -> DataFrame:
    """Letter trigrams of prose words (trigram), counted over all texts by distinct word."""
    t = F.lower(F.col(text).cast("string"))
    w = documents.select(F.explode(F.regexp_extract_all(t, F.lit(r"(?<![\p{L}\p{N}])\p{L}{4,}+(?![\p{N}])"), F.lit(0))).alias("w"))
    w = w.groupBy("w").agg(F.count("*").alias("n"))
    g = cut(_trigrams(w, "w").groupBy("trigram").agg(F.sum("n").alias("n")))
    least = F.greatest(F.lit(DICTIONARY_LEAST), F.col("total") * F.lit(DICTIONARY_SHARE))
    return g.crossJoin(g.agg(F.sum("n").alias("total"))).filter(F.col("n") >= least).select("trigram")


def _trigrams(df: DataFrame, col: str) -> DataFrame:
    places = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(col) - 2)))
    return df.withColumn("place", places).withColumn("trigram", F.expr(f"substring({col}, place, 3)")).drop("place")


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with its features but word_rate, and the word before."""
    n = F.length("value").cast("double")
    share = lambda chars: F.regexp_count("value", F.lit(chars)) / n
    turns = r"(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
    word = _name(F.col("before"))
    assigned = F.col("before").rlike(rf"(?:{_ASSIGN}|(?i:{_BEARER}))$")
    f = found.withColumns({
        "length": n, "digits": share("[0-9]"), "uppers": share("[A-Z]"), "lowers": share("[a-z]"), "transitions": share(turns),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / n, "slashes": share("/"),
        "in_path": (F.col("before").rlike(r"[/\\.:~][\w.\-]*$") & ~assigned).cast("double"),
        "word": word, "key_word": _key_word(word).cast("double"),
        "assigned": assigned.cast("double"),
        "quoted": (F.col("before").rlike(r"""["'`]$""") & F.col("after").rlike(r"""^["'`]""")).cast("double"),
    })
    v = _trigrams(found.select("value").distinct().withColumn("w", F.lower("value")), "w")
    v = v.join(known.withColumn("hit", F.lit(1.0)), "trigram", "left").groupBy("value").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("coverage"))
    return f.join(v, "value")


def word_rates(labelled: DataFrame) -> DataFrame:
    """(word, word_rate): share of real findings after a word, towards one half for rare words."""
    return labelled.groupBy("word").agg(((F.sum("label") + 1) / (F.count("*") + 2)).alias("word_rate"))


def fit(labelled: DataFrame, rates: DataFrame) -> RandomForestClassificationModel | None:
    """The forest from labelled findings with features (label 0 or 1), or None without both classes."""
    w = Window.partitionBy("label").orderBy(F.xxhash64("value", "doc_id", "start"))
    some = labelled.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= FIT_PER_CLASS)
    some = cut(_with_rate(some, rates).select(F.col("label").cast("double").alias("label"), *FEATURES))
    if some.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(some)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)


def _with_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    return df.join(rates, "word", "left").withColumn("word_rate", F.coalesce("word_rate", F.lit(0.5)))


def by_rule(df: DataFrame) -> Column:
    """Weak label where no reviewed findings are given, null where it is unclear.

    1: a value assigned to a key-like name, quoted or not, that is no prose;
    0: a placeholder, or without such a name a number, a path or prose.
    """
    named = (F.col("key_word") == 1) & (F.col("assigned") == 1)
    empty = F.col("value").rlike(PLACEHOLDER)
    path = F.col("value").rlike(FILE_PATH)
    plain = (F.col("digits") == 1) | (F.col("in_path") == 1) | path | (F.col("coverage") >= 0.5)
    real = named & ~empty & ~path & (F.col("length") >= 8) & (F.col("coverage") < 0.5)
    return F.when(real, 1).when((named & empty) | (~named & (F.col("key_word") == 0) & plain), 0).cast("int")


def scan(documents: DataFrame, labelled: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every candidate: doc_id, start, length, value_sha256, score (share of the forest), secret (score of one half or more).

    labelled: reviewed findings (doc_id, start, label); by default the
    candidates themselves under the weak label of ``by_rule``, without unclear ones.
    """
    found = cut(features(cut(candidates(documents, doc_id, text)), dictionary(documents, text)))
    if labelled is None:
        taught = found.withColumn("label", by_rule(found)).filter("label is not null")
    else:
        taught = found.join(labelled.select("doc_id", "start", "label"), ["doc_id", "start"])
    rates = cut(word_rates(taught))
    model = fit(taught, rates)
    base = ["doc_id", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256")]
    if model is None:
        return found.select(*base, F.lit(None).cast("double").alias("score"), F.lit(True).alias("secret"))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_rate(found, rates))
    p = vector_to_array("probability")[1]
    return model.transform(rows).withColumn("score", p).select(*base, "score", (F.col("score") >= 0.5).alias("secret"))
