"""Op 3: secret scan; a random forest removes the false positives.

Candidates are runs of key characters that are long and hold a digit or are very long. For each: its length, shares of
character classes, transitions between classes and between letters, how much of it dictionary words cover, marks of
its path, and of the words around it. A random forest (Spark ML, in the JVM) trained from labelled findings gives the
probability of a real secret. Without labelled findings of one's own, ``labelled_findings`` makes some by rule:
keys of the usual shapes in assignments, against identifiers, checksums, numbers, placeholders and long words.

Plan. Texts stay where they lie: candidates, features and forest are row expressions, so the scan has no shuffle.
The training set is bounded (``n`` rows); the forest has a fixed number of trees of bounded depth.

Defined results. Null and empty texts have no candidates. A null path counts as empty. The same string found twice is
two findings, each with its own span. Whole texts are scanned, candidates of any length. Extra columns are not
carried.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import let, table

BODY = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
# Words that tell of a secret, of something else, and that name or fill things; lower case.
ASSIGNING = "token|secret|passw|pwd|api|key|auth|credential|bearer|private|access"
HARMLESS = "commit|sha|md5|hash|checksum|digest|uuid|guid|etag|integrity|revision|build|version|example|sample|dummy|placeholder|test|card|phone|order|isbn|tracking"
HARMLESS_PATH = "test|example|sample|fixture|mock|docs|vendor|node_modules|dist|lock|locale"
DICTIONARY = (
    "the|and|for|with|this|that|from|example|sample|test|dummy|placeholder|your|here|insert|change|value|name|user|index|table|"
    "config|setting|option|default|client|server|service|request|response|handler|manager|factory|builder|message|number|string|"
    "object|array|list|item|data|file|path|image|style|color|width|height|button|field|form|page|view|controller|model|module|"
    "package|class|function|method|parameter|argument|return|error|exception|result|status|state|event|listener|callback|"
    "tion|ment|ing|ness|able|ible|ous|ive|ity|ance|ence|lich|keit|heit|schaft|ung|eur|ique|cion|dad|mente"
)
COMMON_PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur"
FEATURES = [
    "length", "digits", "uppers", "lowers", "symbols", "hexes", "class_changes", "common_pairs", "vowels", "distinct",
    "covered", "assigning", "harmless", "assigned", "quoted", "path_harmless", "path_depth", "groups",
]


def findings(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Candidates: ``key, start, candidate, before, own, after, path``; ``start`` in code points from 0."""
    blank = r"[\x20\x09-\x0D]"

    def spans(ws: Column) -> Column:
        at = F.filter(F.sequence(F.lit(1), F.size(ws)), lambda i: (F.length(F.element_at(ws, i)) >= 16) & F.element_at(ws, i).rlike(BODY))

        def one(i: Column) -> Column:
            word = lambda k: F.coalesce(F.when(i + k >= 1, F.try_element_at(ws, i + k)), F.lit(""))
            return F.struct(
                F.aggregate(F.slice(ws, 1, i - 1), F.lit(0).cast("long"), lambda s, w: s + F.length(w) + 1).alias("offset"),
                F.concat_ws(" ", word(-3), word(-2), word(-1)).alias("before"),
                F.element_at(ws, i).alias("own"),
                F.concat_ws(" ", word(1), word(2)).alias("after"),
            )

        return F.transform(at, one)

    found = docs.filter(F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.inline(let(F.split(F.col(text), blank, -1), spans))
    )
    runs = F.regexp_extract_all("own", F.lit(f"({BODY})"), F.lit(1))
    # a word may hold several runs: each starts where the text before it, cut by the runs ahead, ends
    found = found.select("*", F.posexplode(runs).alias("n", "candidate"))
    ahead = F.aggregate(
        F.slice(runs, 1, F.col("n")), F.struct(F.lit(0).alias("at"), F.col("own").alias("rest")),
        lambda s, r: F.struct((s["at"] + F.instr(s["rest"], r) - 1 + F.length(r)).cast("int").alias("at"), F.substring(s["rest"], F.instr(s["rest"], r) + F.length(r), F.length(s["rest"])).alias("rest")),
    )
    start = F.col("offset") + let(ahead, lambda s: s["at"] + F.instr(s["rest"], F.col("candidate")) - 1)
    kept = F.col("candidate").rlike("[0-9]") | (F.length("candidate") >= 24)
    return found.filter(kept).select("key", start.alias("start"), "candidate", "before", "own", "after", "path")


def features(found: DataFrame) -> DataFrame:
    """``found`` (``candidate, before, own, after, path``) with the forest's columns."""
    c, low = F.col("candidate"), F.lower("candidate")
    n = F.length(c).cast("double")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    near = F.lower(F.concat_ws(" ", F.col("before"), F.regexp_replace("own", BODY, " "), F.col("after")))
    prior = F.concat(F.col("before"), F.lit(" "), F.expr("substring_index(own, candidate, 1)"))
    return found.withColumns(
        {
            "length": n,
            "digits": share("[0-9]"),
            "uppers": share("[A-Z]"),
            "lowers": share("[a-z]"),
            "symbols": share("[^A-Za-z0-9]"),
            "hexes": share("[0-9a-fA-F]"),
            "class_changes": share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
            "common_pairs": F.regexp_count(low, F.lit(f"(?=(?:{COMMON_PAIRS}))")) / n,
            "vowels": F.regexp_count(low, F.lit("[aeiou]")) / n,
            "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
            "covered": 1 - F.length(F.regexp_replace(low, DICTIONARY, "")) / n,
            "assigning": near.rlike(ASSIGNING).cast("double"),
            "harmless": near.rlike(HARMLESS).cast("double"),
            "assigned": F.rtrim(F.regexp_replace(prior, "[\"'`]+$", "")).rlike("[=:]$").cast("double"),
            "quoted": prior.rlike("[\"'`]$").cast("double"),
            "path_harmless": F.lower("path").rlike(HARMLESS_PATH).cast("double"),
            "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
            "groups": F.size(F.split(c, "[-_/]")).cast("double"),
        }
    )


def labelled_findings(spark: SparkSession, n: int = 6000, seed: int = 1) -> DataFrame:
    """Labelled findings by rule: ``candidate, before, own, after, path, label``; half of them secrets."""
    h = lambda k: F.sha2(F.concat_ws(":", F.col("id").cast("string"), F.lit(f"{seed}.{k}")), 256)
    pick = lambda k, options: F.element_at(F.array(*[F.lit(o) if isinstance(o, str) else o for o in options]), (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col("id")), F.lit(len(options))) + 1).cast("int"))
    number = lambda k, lo, hi: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col("id")), F.lit(hi - lo + 1)) + lo).cast("int")
    b64 = F.regexp_replace(F.base64(F.unhex(h(1))), "=+$", "")
    word = lambda k: pick(k, DICTIONARY.split("|"))
    syllable = lambda k: F.concat(pick(k, COMMON_PAIRS.split("|")), pick(k + 1, COMMON_PAIRS.split("|")))
    digits = F.conv(F.substring(h(2), 1, 14), 16, 10)
    real = pick(10, [F.substring(h(3), 1, 32), F.substring(h(3), 1, 40), h(3), F.substring(b64, 1, 24), F.substring(b64, 1, 40), F.concat(F.lit("AKIA"), F.upper(F.substring(h(4), 1, 16))), F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(b64, "[+/]", "x"), 1, 36)), F.concat(F.lit("sk-"), F.substring(F.regexp_replace(b64, "[+/]", "y"), 1, 40))])
    words_ = F.concat(syllable(20), syllable(22), syllable(24), syllable(26), syllable(28), F.substring(F.concat(syllable(30), syllable(32), syllable(34)), 1, number(36, 0, 12)))
    other = pick(
        11,
        [
            F.substring(h(5), 1, 40), h(6), F.substring(digits, 1, 16), F.concat(word(40), F.initcap(word(41)), F.initcap(word(42)), F.initcap(word(43)), number(44, 1, 99).cast("string")),
            F.concat_ws("_", word(45), word(46), word(47), word(48), number(49, 1, 9).cast("string")), F.concat_ws("/", word(50), word(51), word(52), word(53), number(54, 1, 9999).cast("string")),
            F.rpad(F.lit("xxxx"), 24, "x"), F.concat(F.lit("your-"), word(55), F.lit("-key-here-0000")), words_, F.concat(words_, words_), F.concat_ws("-", F.substring(h(7), 1, 8), F.substring(h(7), 9, 4), F.substring(h(7), 13, 4), F.substring(h(7), 17, 4), F.substring(h(7), 21, 12)), F.concat(digits, digits),
        ],
    )
    hashed = (F.length("candidate") >= 32) & F.col("candidate").rlike("^[0-9a-f-]+$")
    base = spark.range(n).withColumn("label", (F.col("id") % 2).cast("double")).withColumn("candidate", F.when(F.col("label") == 1, real).otherwise(other))
    good = pick(60, ["{w} token =", "set api_key:", "{w} {w} secret =", "password =", "Authorization: Bearer", "{w} the access_key =", "private key:", "{w} credentials:", "{w} {w} {w}"])
    bad = F.when(hashed, pick(61, ["commit", "sha256:", "{w} checksum", "md5 digest", "build revision", "etag:"])).otherwise(
        pick(62, ["{w} {w} {w}", "{w} {w}", "card", "order {w}", "example key =", "{w} = ", "import", "see {w}", "token ="])
    )
    ctx = F.regexp_replace(F.when(F.col("label") == 1, good).otherwise(bad), r"\{w\}", "thing")
    path = F.when(F.pmod(F.col("id"), F.lit(3)) == 0, pick(63, ["src/app/main.py", "config/prod.env", "deploy/settings.yaml"])).otherwise(pick(64, ["", "src0", "web/page", "tests/fixtures/data.json", "docs/example.md"]))
    quote = pick(65, ['"', "'", ""])
    return base.withColumns({"before": ctx, "path": F.when(F.col("label") == 1, F.when(path.rlike(HARMLESS_PATH), F.lit("")).otherwise(path)).otherwise(path)}).select(
        "candidate", "before", F.concat(quote, "candidate", quote).alias("own"), F.lit("").alias("after"), "path", "label"
    )


def trained(labelled: DataFrame, *, trees: int = 20, depth: int = 7, seed: int = 7) -> PipelineModel:
    """A forest from labelled findings (``candidate, before, own, after, path, label``)."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="x")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    data = assembler.transform(features(labelled.coalesce(1)))
    return PipelineModel([assembler, forest.fit(data)])


def scan(docs: DataFrame, model: PipelineModel, *, key: str = "doc_id", text: str = "text", path: str = "source", least: float = 0.5) -> DataFrame:
    """Findings with ``score`` and ``is_secret`` (score of ``least`` or more)."""
    out = model.transform(features(findings(docs, key=key, text=text, path=path)))
    score = F.element_at(vector_to_array("probability"), 2)
    return out.select("key", "start", "candidate", "path", score.alias("score")).withColumn("is_secret", F.col("score") >= least)


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    """Query: every candidate of every document with its verdict; the string itself only as a digest."""
    model = trained(labelled_findings(spark))
    out = scan(table(spark, sf_dir, "documents"), model)
    return out.select(F.col("key").alias("doc_id"), "start", F.length("candidate").cast("long").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")
