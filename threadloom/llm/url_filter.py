"""Allow and block verdicts for URLs: listed rules first, else a trained scorer of the URL's letters.

A rule is a host with a path, ``example.net/en/``. It fits that host and its subdomains where the
path of the URL starts with the rule's; of several that fit, the longest wins. Where none
fits, a logistic regression on hashed character n-grams of host and path decides. It is
fitted on a small labelled table of URLs, a parameter, on the cluster; scoring stays in the JVM.

A null URL or one without ``://`` has an empty host and an empty path; it is scored as such and the
intercept of the fitted regression decides. Very long URLs are read whole. Repeated rows are
judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.plans.materialize import scratch_path

#: (verdict, host/path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: The small labelled table: label 1 (unwanted) and 0, written out as hosts; paths are added by rule.
UNWANTED = (
    "best-casino online-casino casino-royal casino-bonus poker-stars sport-bets bets-today best-bets bets-online "
    "live-betting pills-online buy-pills diet-pills cheap-meds spam-mail spam-host link-farm click-farm content-farm "
    "win-cash win-prizes lottery-win big-win jackpot-slots slots-online cheap-loans payday-loans fast-loans "
    "replica-watches cheap-watches cheap-tickets free-followers buy-followers free-cams free-spins free-prizes "
    "adult-cams adult-video adult-chat crack-keygen warez-crack banner-ads ads-click popup-ads ad-server pixel-track "
    "track-clicks"
).split()
WANTED = (
    "library museum university school weather history science gardening cooking recipes travel maps news daily "
    "journal archive forum wiki docs blog astronomy physics biology music theatre cinema books poetry letters "
    "parliament council railway harbour hospital pharmacy theory nature another thirteen northern leather mother "
    "weathering tether rather hither station education fashion translation motion english finish shipping"
).split()
ENDINGS = ("example.com", "example.net", "example.org", "test")
PATHS = ("/", "/en/12", "/de/index.html", "/fr/77?page=2", "/es/a/b")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url``, ``label``: each host with every ending, the paths dealt out in turn to both labels alike."""
    rows = [
        (f"https://{('', 'www.', 'blog.', 'm.')[k % 4]}{name}.{ending}{PATHS[(k + j) % len(PATHS)]}", label)
        for label, names in ((1.0, UNWANTED), (0.0, WANTED))
        for k, name in enumerate(names)
        for j, ending in enumerate(ENDINGS)
    ]
    return spark.createDataFrame(rows, "url string, label double")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    whole = F.coalesce(url, F.lit(""))
    found = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(whole, found, 1), upper, lower), F.regexp_extract(whole, found, 2)


def winning_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last one tried wins
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def char_grams(host: Column, path: Column, sizes: Sequence[int]) -> Column:
    """Every character n-gram of host and path, marked with where it comes from."""
    parts = []
    for mark, part in (("h", host), ("p", path)):
        framed = F.concat(F.lit("^"), part, F.lit("$"))
        for n in sizes:  # a look-ahead matches at every place, so the grams overlap
            grams = F.regexp_extract_all(framed, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
            parts.append(F.transform(grams, lambda gram, mark=mark: F.concat(F.lit(mark), gram)))
    return F.concat(*parts)


def _featured(df: DataFrame, url: str, sizes: Sequence[int], buckets: int) -> DataFrame:
    host, path = url_parts(F.col(f"`{url}`"))
    parts = df.withColumn("host", host).withColumn("path", path)
    grams = parts.withColumn("_grams", char_grams(F.col("host"), F.col("path"), sizes))
    return HashingTF(numFeatures=buckets, binary=True, inputCol="_grams", outputCol="_features").transform(grams)


def train(
    labelled: DataFrame, sizes: Sequence[int] = (3, 4), buckets: int = 1 << 14, strength: float = 0.01
) -> LogisticRegressionModel:
    """Fit on ``url``, ``label``: a small table, kept in one partition so that reruns agree to the bit."""
    fitted = LogisticRegression(
        featuresCol="_features",
        labelCol="label",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        predictionCol="_predicted",
        regParam=strength,
        maxIter=60,
    )
    model = fitted.fit(_featured(labelled.coalesce(1), "url", sizes, buckets).select("_features", "label"))
    # Written and read again: the fresh model leaves the training summary and its session behind,
    # which can't be sent to executors.
    path = scratch_path(labelled.sparkSession, "url-model")
    model.save(path)
    return LogisticRegressionModel.load(path)


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    labelled: DataFrame | None = None,
    sizes: Sequence[int] = (3, 4),
    buckets: int = 1 << 14,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` (of being unwanted) and ``verdict``.

    Columns of ``pages`` with one of these names give way; all others come back as they were, whatever their names.
    """
    model = train(labelled if labelled is not None else labelled_urls(pages.sparkSession), sizes, buckets)
    given = F.struct(*(F.col(f"`{name}`") for name in pages.columns)).alias("_given")
    scored = model.transform(_featured(pages.select(F.col(f"`{url}`").alias("url"), given), "url", sizes, buckets))
    rule, says = winning_rule(F.col("host"), F.col("path"), rules)
    score = F.element_at(vector_to_array(F.col("_probability")), 2)
    verdict = F.coalesce(says, F.when(score >= 0.5, "block").otherwise("allow"))
    made = {"host": F.col("host"), "path": F.col("path"), "rule": rule, "score": score, "verdict": verdict}
    kept = [F.col(f"_given.`{name}`").alias(name) for name in pages.columns if name not in made]
    return scored.select(*kept, *(value.alias(name) for name, value in made.items()))
