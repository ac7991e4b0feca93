"""Operator 5: secret scanning with a random forest that removes false positives (native).

1. Candidates: words (between white space) that hold a run of ``MIN_RUN`` or more letters, digits and + / = _ -
   with a digit in it, or a letters-only run of ``LONG_RUN``, or a value of eight or more characters assigned to a
   secret's name, in the same word or in the one after name and sign. A word gives every such value (minified JSON,
   query and connection strings are one word), each with its offset in the word, what surrounds it up
   to its neighbours, the two words before and the word after it.
2. Features, all by built-in functions: length; character transitions (between lower, upper, digit and symbol, and
   between vowel and consonant) and character shares; dictionary coverage; path (test-like names, depth,
   a hash bucket); neighbouring words (a secret's name, an assignment sign, quotes, plain words).
   The dictionary is made from the corpus: words of three or four letters a-z in at least
   ``DICTIONARY_SHARE`` of all documents; there are at most 26^3 + 26^4 of them. Coverage is the share of a
   candidate's three- and four-letter windows that are dictionary words.
3. Labelled findings: given as a column, or by high-precision rules (issued-key formats and quoted or
   bare values assigned to a secret's name are secrets; card numbers by checksum, and plain words are not);
   everything else is unlabelled. The forest (JVM, from ``pyspark.ml``) is trained on a bounded,
   seeded sample of labelled findings: about ``TRAIN_ROWS``, a documented parameter.
4. Every candidate gets the forest's probability; ``is_secret`` from ``THRESHOLD`` on.

Shuffles carry counts of short words and candidates only, never texts. Keys are candidates' rows
and short words counted with partial sums, so a hot document or word gathers nowhere.

Defined results: null and empty texts have no candidates; null path counts as empty; null doc_id and repeated
rows give their own findings. With no labelled findings, or of one class only, there is nothing to
learn: the probability is that class (1 if none is labelled) and nothing is removed beyond it. An
empty table gives an empty result. Other input columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_RUN = 16
LONG_RUN = 24
DICTIONARY_SHARE = 1e-3
TRAIN_ROWS = 20000
THRESHOLD = 0.5
SEED = 5
TREES, DEPTH = 40, 8
RUN = r"[A-Za-z0-9+/=_\-]"
#: only where a run begins: a look-ahead from every character of a long run would read it again and again
START = rf"(?<!{RUN})"
NAME = r"(?i)(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth)"
SPACE = r"[\x20\x09-\x0D]+"
# the name without a group; name, sign and opening quote; where the next value of a joined setting begins
_NAMED = NAME.replace("(?i)(", "(?i:", 1)
_SIGN = _NAMED + r"[\"']?[=:][\"']?"
_NEXT_SECRET = rf"[&;,][\"']?[A-Za-z0-9_.\-]*{_SIGN}[^\s\"']{{8}}"
_NEXT = r"[&;,][\"']?[A-Za-z0-9_.\-]+[\"']?[=:]"
_ASSIGNED = rf"{_SIGN}(?:(?!{_NEXT_SECRET})[^\s\"']){{8}}"
GIVEN = rf"{_ASSIGNED}(?:(?!{_NEXT})[^\s\"'])*+"
#: every candidate of a word: assigned values, then runs up to the next assigned value
FOUND = rf"{GIVEN}|{START}(?=(?:(?!{_ASSIGNED})[A-Za-z+/=_\-])*+[0-9])(?:(?!{_ASSIGNED}){RUN}){{{MIN_RUN},}}+" \
        rf"|(?:(?!{_ASSIGNED})[A-Za-z]){{{LONG_RUN},}}+"
#: a word after name and sign: its start is the value
AFTER_SIGN = rf"{GIVEN}|^[\"'`]?(?:(?!{_ASSIGNED}|{_NEXT_SECRET})[^\s\"']){{8}}(?:(?!{_ASSIGNED}|{_NEXT})[^\s\"'])*+|{FOUND}"

FEATURES = ["length", "transitions", "vowel_changes", "distinct", "digits", "uppers", "symbols", "hexadecimal", "coverage",
            "path_test", "path_depth", "path_bucket", "place", "name_inside", "name_before", "assigned", "quoted",
            "plain_before", "plain_after"]


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(cid, doc_id, path, pos, offset, word, value, before2, before, after, place): one row per candidate.

    ``word``: the candidate and what stands between it and its neighbours in the same word.
    """
    has_digit = rf"{START}(?=[A-Za-z+/=_\-]*+[0-9]){RUN}{{{MIN_RUN},}}"
    wanted = rf"{has_digit}|[A-Za-z]{{{LONG_RUN},}}|{NAME}[\"']?[=:][\"']?[^\s\"']{{8,}}"
    spaced = rf"{_NAMED}[\"']?(?:{SPACE})?[=:]{SPACE}[^\x20\x09-\x0D]{{8}}"
    words = F.split(F.col(text), SPACE)
    marked = docs.where(F.col(text).rlike(f"{wanted}|{spaced}")) \
        .select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
                words.alias("w"), F.monotonically_increasing_id().alias("row"))

    def near(i: Column, k: int) -> Column:
        word = F.coalesce(F.try_element_at("w", i + 1 + k), F.lit(""))
        return word if k >= 0 else F.when(i >= -k, word).otherwise("")

    def after_sign(i: Column) -> Column:
        return near(i, -1).rlike(_NAMED + r"[\"']?[=:]$") | (near(i, -1).rlike("^[=:]$") & near(i, -2).rlike(_NAMED + r"[\"']?$"))
    at = F.filter(F.transform("w", lambda s, i: F.when(s.rlike(wanted) | ((F.length(s) >= 8) & after_sign(i)), i)),
                  lambda i: i.isNotNull())
    # neighbours are looked up before the explode, so that no row carries the document
    one = marked.select("doc_id", "path", "row", F.explode(F.transform(at, lambda i: F.struct(
        i.alias("pos"), near(i, 0).alias("whole"), near(i, -2).alias("before2"), near(i, -1).alias("before"),
        near(i, 1).alias("after"), (i / F.size("w")).alias("place"), after_sign(i).alias("signed")))).alias("x")) \
        .select("doc_id", "path", "row", "x.*")

    def cut(pattern: str) -> Column:
        """(gap before, match, gap after) of every match, in order."""
        gaps = F.split("whole", pattern)
        found = F.regexp_extract_all("whole", F.lit(pattern), F.lit(0))
        pairs = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
        return F.filter(F.zip_with(pairs, F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))), lambda x, t: F.struct(
            x["g"].alias("g"), x["m"].alias("m"), F.coalesce(t, F.lit("")).alias("t"))), lambda x: x["m"].isNotNull())
    none = F.array().cast("array<struct<m: string, start: int, word: string>>")
    placed = F.aggregate(
        F.when(F.col("signed"), cut(AFTER_SIGN)).otherwise(cut(FOUND)), F.struct(F.lit(0).alias("n"), none.alias("out")),
        lambda a, x: F.struct((a["n"] + F.length(x["g"]) + F.length(x["m"])).alias("n"), F.concat(a["out"], F.array(F.struct(
            x["m"].alias("m"), (a["n"] + F.length(x["g"])).alias("start"), F.concat(x["g"], x["m"], x["t"]).alias("word")))).alias("out")),
        lambda a: a["out"])
    each = one.select("*", F.explode(placed).alias("f")).select("*", "f.m", "f.start", "f.word")
    given = F.col("m").rlike(f"^{_ASSIGNED}")
    value = F.when(given, F.regexp_replace("m", f"^{_SIGN}", "")).otherwise(F.regexp_replace("m", "^[\"'`]", ""))
    # the value after a sign ends before the punctuation of its sentence, unless too little is left or it is quoted
    bare = F.regexp_replace(value, r"(?<![.,;:)\]}`])[.,;:)\]}`]+$", "")
    ended = F.when(~given & ~F.col("m").rlike("^[\"']") & (F.length(bare) >= 8), bare).otherwise(value)
    return each.withColumn("offset", F.col("start") + F.length("m") - F.length(value)).withColumn("value", ended) \
        .select("doc_id", "path", "pos", "offset", F.xxhash64("row", "pos", "offset").alias("cid"), "word", "before2", "before", "after",
                "place", "value")


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE, text: str = "text") -> DataFrame:
    """(gram): three- and four-letter words in at least ``share`` of all documents."""
    short = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\b([a-z]{3,4})\b"), F.lit(1)))
    counted = docs.select(F.explode(short).alias("gram")).groupBy("gram").count()
    least = docs.count() * share
    return counted.where(F.col("count") >= least).select("gram")


def _changes(s: Column) -> Column:
    """Places where neighbouring characters differ, after collapsing."""
    return F.greatest(F.length(F.regexp_replace(s, r"(.)\1+", "$1")) - 1, F.lit(0))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` plus the columns of ``FEATURES``."""
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "l"), "[A-Z]", "U"), "[0-9]", "0"),
                             "[^lU0]", "-")
    vowels = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(v), "[aeiouy]", "1"), "[a-z]", "2"), "[^12]", "")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    plain = r"^[a-zà-ÿ]{1,12}[.,;]?$"
    f = found.select(
        "*", n.cast("double").alias("length"), (_changes(kinds) / n).alias("transitions"),
        (_changes(vowels) / F.greatest(F.length(vowels), F.lit(1))).alias("vowel_changes"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("distinct"), share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"), share("[^A-Za-z0-9]").alias("symbols"),
        v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hexadecimal"),
        F.col("path").rlike("(?i)test|spec|mock|example|sample|fixture").cast("double").alias("path_test"),
        F.size(F.split("path", "/")).cast("double").alias("path_depth"),
        F.pmod(F.xxhash64("path"), F.lit(32)).cast("double").alias("path_bucket"),
        F.col("word").rlike(NAME + r"[\"']?[=:]").cast("double").alias("name_inside"),
        (F.col("before").rlike(NAME) | F.col("before2").rlike(NAME)).cast("double").alias("name_before"),
        (F.col("before").rlike("[=:]$") | F.col("word").rlike("[A-Za-z][=:]")).cast("double").alias("assigned"),
        F.col("word").rlike("[\"'`]").cast("double").alias("quoted"),
        F.col("before").rlike(plain).cast("double").alias("plain_before"),
        F.col("after").rlike(plain).cast("double").alias("plain_after"))
    low = F.lower(v)
    # every place where three or four letters follow, in one scan each
    windows = F.concat(*[F.regexp_extract_all(low, F.lit(f"(?=([a-z]{{{k}}}))"), F.lit(1)) for k in (3, 4)])
    grams = f.select("cid", F.explode(windows).alias("gram"))
    known = words.withColumn("known", F.lit(1))
    # of all windows, also those with digits: a word inside a key covers little of it
    hits = grams.join(known, "gram").groupBy("cid").agg(F.count("*").alias("hits"))
    return f.join(hits, "cid", "left").withColumn(
        "coverage", F.coalesce("hits", F.lit(0)) / F.greatest(F.length("value") * 2 - 5, F.lit(1))).drop("hits")


def _card(value: Column) -> Column:
    """13 to 19 digits whose checksum holds, the way payment card numbers are made."""
    digits = F.transform(F.reverse(F.split(value, "")), lambda c, i: F.when(i % 2 == 0, c.try_cast("int"))
                         .otherwise(c.try_cast("int") * 2 - F.when(c.try_cast("int") > 4, 9).otherwise(0)))
    return value.rlike("^[0-9]{13,19}$") & (F.aggregate(digits, F.lit(0), lambda a, x: a + x) % 10 == 0)


def rule_labels(found: DataFrame) -> DataFrame:
    """``found`` plus ``label``: 1 for issued-key formats and assigned values, 0 for card numbers and plain words."""
    v = F.col("value")
    key = v.rlike(r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abpr]-[A-Za-z0-9-]{10,})$")
    named = F.col("word").rlike(NAME + r"[\"']?[=:][\"']?[^\s\"']{8,}") | \
        (F.col("before").rlike("^[=:]$") & F.col("before2").rlike(NAME + r"[\"']?$"))
    word = v.rlike("^[A-Za-z]+$") & ~named
    return found.withColumn("label", F.when(key | (named & v.rlike("[0-9]")), 1.0).when(_card(v) | word, 0.0))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED):
    """A forest on about ``rows`` labelled findings (columns of FEATURES, label), or the one label there is, or None."""
    known = labelled.where("label is not null")
    n = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(n) < 2:
        return next(iter(n), None)
    # either class keeps the same number where it can; the seeded hash of the finding decides
    h = F.pmod(F.xxhash64(F.lit(seed), "value", "word", "before", "after"), F.lit(1 << 30)) / float(1 << 30)
    part = F.lit(0.0)
    for label, count in n.items():
        part = F.when(F.col("label") == label, F.lit(min(1.0, rows / 2 / count))).otherwise(part)
    order = [*FEATURES, "label"]
    sample = known.where(h < part).select(*order).repartition(1).sortWithinPartitions(*order)
    sample = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(sample).select("vector", "label")
    return RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed,
                                  featureSubsetStrategy="sqrt").fit(sample.checkpoint())


def scan(docs: DataFrame, labels: DataFrame | None = None, threshold: float = THRESHOLD, doc_id: str = "doc_id",
         text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, pos, offset, value, probability, is_secret): every candidate, scored.

    ``labels(value, label)``: labelled findings (1 secret, 0 false positive); rules label them if it is None.
    """
    found = features(candidates(docs, doc_id, text, path), dictionary(docs, text=text)).checkpoint()
    if labels is None:
        labelled = rule_labels(found)
    else:
        given = labels.groupBy("value").agg(F.max("label").cast("double").alias("label"))
        labelled = found.join(given, "value", "left")
    model = train(labelled)
    if model is None or isinstance(model, float):
        scored = found.withColumn("probability", F.lit(1.0 if model is None else model))
    else:
        vector = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(found)
        scored = model.setProbabilityCol("p").setFeaturesCol("vector").transform(vector) \
            .withColumn("probability", vector_to_array("p")[1])
    return scored.select("doc_id", "pos", "offset", "value", "probability", (F.col("probability") >= threshold).alias("is_secret"))


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "pos", "offset", F.md5("value").alias("value_md5"), F.round("probability", 6).alias("probability"),
                        "is_secret")
