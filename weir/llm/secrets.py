"""Operator 5, secret scans: random forest over candidates (DataFrame functions
and ``pyspark.ml`` only).

A candidate is a run of at least ``MIN_RUN`` characters of ``[A-Za-z0-9+/_-]``, or a
value of any length that is assigned to a secret-like name (``NAMES``), in one word
(``pwd=x``, ``"token":"x"``) or over several (``pwd: x``, ``pwd = x``). A run is no
candidate but a neighbouring name where ``=`` or ``:`` follows and it is made of plain
words joined by ``_`` or ``-``, or holds a secret-like name and at most two digits; any
other run before ``=`` or ``:`` (``AKIA...:value``) stays one. A word with several
candidates (packed .env, JSON, CSV) is cut after each, and the parts are words of their
own to the features: a part's neighbours are the parts and words beside it. A forest over its length, character transitions, dictionary
coverage, path and neighbouring words, trained from labelled findings, tells
secrets from false positives (long words, digit runs, paths, links); findings
below ``THRESHOLD`` are removed. The forest is fitted on at most ``TRAIN_ROWS``
labelled findings of each label (the smallest by a hash), gathered in one
partition so that reruns agree; everything else covers all rows. The dictionary is
the ``DICTIONARY`` most frequent words of three to ten letters of all documents.

Where no table of labelled findings is at hand (``label_by_format``), findings that
follow a published key format (``AKIA`` and sixteen upper-case characters), or are a hex
or base64 value assigned to a name such as password or token, are labelled 1, and
runs without a digit, or of digits alone, 0; all others, also assigned values under
``MIN_LABELLED`` characters, stay unlabelled and are judged by the forest. The labels use the format, the forest does not see it.

Defined cases: null and empty texts have no candidate; findings are one row per
candidate, numbered by ``position`` (of the word) and ``run_index`` (in the word), so
repeated rows give repeated findings and copies inside a text each count; an assigned
value ends at a blank, also inside quotes; very long texts are split once and only words that match
are kept; without labelled findings of both labels no finding is removed
(``p_secret`` null); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.text import write_table

MIN_RUN = 16
TRAIN_ROWS = 2000
MIN_ROWS = 5
THRESHOLD = 0.5
DICTIONARY = 300
TREES, DEPTH, SEED = 20, 6, 7

#: Shortest value assigned to a secret-like name that its format labels 1.
MIN_LABELLED = 8

CHARS = r"A-Za-z0-9+/_\-"
#: First character of an assigned value.
START = r"[^\s\"'`,;&|=:)}\]>\\]"
#: ``=`` belongs to a run as padding where no value follows.
RUN = rf"[{CHARS}]{{{MIN_RUN},}}+(?:={{1,2}}+(?!\\?[\"'`]?{START}))?"
BLANKS = r"[\x20\x09-\x0D]+"
#: Names that secrets are assigned to.
NAMES = r"(?i:pass(?:word|wd)?|pwd|secret|token|api[_\-]?key|access[_\-]?key|auth|credential)"
IS = r"(?:=>|:=|[=:])"
#: The end of a secret-like name, and that with its sign of assignment.
NAMED = NAMES + r"[A-Za-z0-9_\-]{0,64}\\?[\"'`]?"
ASSIGN = NAMED + IS
#: A run that names the value behind it.
LONG_NAME = (rf"(?:[a-z]++(?:[_\-]++[a-z]++)++|[A-Z]++(?:[_\-]++[A-Z]++)++"
             rf"|(?=[A-Za-z0-9_\-]*?{NAMES})[A-Za-z_\-]++(?:[0-9][A-Za-z_\-]*+){{0,2}}+)"
             rf"\\?[\"'`]?{IS}(?:\\?[\"'`]?{START}|$)")
_LONG = rf"(?<![{CHARS}])(?=[{CHARS}]{{{MIN_RUN}}})"
_VALUE = rf"(?!\\[\"'`]|{_LONG})"
#: The next candidate of a word (group 2) and all that stands before it (group 1).
#: Loops are possessive where they can be long: the matcher does not recurse into them.
NEXT = (rf"(?s)\G(.*?(?:{_LONG}(?!{LONG_NAME})|{ASSIGN}\\?[\"'`]?(?!{ASSIGN})))"
        rf"({RUN}|(?<=[\"'`])(?:{_VALUE}[^\s\"'`])++|(?<=[=:>])(?:{_VALUE}[^\s\"'`,;&|)}}\]])++)")
#: Stands for a secret-like name in the words before.
GIVEN = "token="
FEATURES = ["run_length", "distinct", "transitions", "digits", "uppers", "hex_only", "vowels", "coverage",
            "slashes", "in_link", "in_path", "quoted", "named_here", "named_before", "assigned", "long_before", "long_after"]


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: bool = False) -> DataFrame:
    """``doc_id, position, word, run, before1, before2, after``: one row per candidate;
    with ``index`` also ``run_index``, its number in the word."""
    t = F.col(f"`{text_col}`")
    words = F.split(t, BLANKS)
    at = lambda i: F.coalesce(F.get(F.col("w"), i), F.lit(""))

    def given(i: Column) -> Column:
        """Whether the words before assign to a secret-like name."""
        near = at(i - 1)
        sign = near.endswith("=") | near.endswith(":") | near.endswith(">")
        return sign & F.concat_ws(" ", at(i - 2), near).rlike(NAMED + r"\x20?" + IS + "$")

    hits = F.filter(F.transform(F.col("w"), lambda x, i: F.struct(
        i.alias("i"), given(i).alias("given"), x.rlike(f"{RUN}|{ASSIGN}").alias("hit"))), lambda x: x["hit"] | x["given"])
    d = df.where(t.rlike(rf"{RUN}|{NAMED}\s*{IS}")).select(F.col(f"`{id_col}`").alias("doc_id"), words.alias("w"))
    d = d.select("doc_id", "w", F.explode(hits).alias("h"))
    i = F.col("h.i")
    d = d.select("doc_id", i.cast("long").alias("position"), at(i).alias("whole"), at(i - 1).alias("b1"), at(i - 2).alias("b2"),
                 at(i + 1).alias("a1"), F.concat(F.when(F.col("h.given"), GIVEN).otherwise(""), at(i)).alias("s"),
                 F.when(F.col("h.given"), len(GIVEN)).otherwise(0).alias("skip"))
    d = d.withColumns({"leads": F.regexp_extract_all("s", F.lit(NEXT), F.lit(1)), "runs": F.regexp_extract_all("s", F.lit(NEXT), F.lit(2))})
    parts = F.zip_with("leads", "runs", lambda a, b: F.concat(a, b))
    rest = F.expr("substr(s, aggregate(__parts, 1, (n, p) -> n + length(p)))")
    # Each part ends with its candidate, the last with the word.
    d = d.where(F.size("runs") > 0).withColumn("__parts", parts).withColumn("parts", F.when(F.size("runs") == 1, F.array("whole")).otherwise(
        F.transform("__parts", lambda p, k: F.concat(
            F.when(k == 0, F.substr(p, F.col("skip") + 1)).otherwise(p), F.when(k == F.size("__parts") - 1, rest).otherwise("")))))
    near = F.concat(F.array("b2", "b1"), F.col("parts"), F.array("a1"))
    d = d.select("doc_id", "position", near.alias("near"), F.posexplode("runs").alias("run_index", "run"))
    k = F.col("run_index")
    out = d.select("doc_id", "position", k.cast("long").alias("run_index"), F.get("near", k + 2).alias("word"), "run",
                   F.get("near", k + 1).alias("before1"), F.get("near", k).alias("before2"), F.get("near", k + 3).alias("after"))
    return out if index else out.drop("run_index")


def frequent_words(df: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The dictionary: a top-k of word counts over all rows; only its ``size`` words reach the driver."""
    w = df.select(F.explode(F.split(F.lower(F.col(f"`{text_col}`")), r"[^a-z]+")).alias("w"))
    w = w.where(F.length("w").between(3, 10)).groupBy("w").count()
    return [r.w for r in w.orderBy(F.desc("count"), "w").limit(size).collect()]


def _share(run: Column, pattern: str) -> Column:
    return (F.length(run) - F.length(F.regexp_replace(run, pattern, ""))) / F.length(run)


def with_features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    run, word = F.col("run"), F.col("word")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(run, "[0-9]", "\u0001"), "[A-Z]", "\u0002"), "[a-z]", "\u0003")
    flag = lambda c: c.cast("double")
    covered = _share(F.lower(run), "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))) if dictionary else F.lit(0.0)
    before = F.concat_ws(" ", "before2", "before1")
    return found.withColumns({
        "run_length": F.length(run).cast("double"),
        "distinct": F.size(F.array_distinct(F.split(run, ""))) / F.length(run),
        "transitions": (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / F.length(run),
        "digits": _share(run, "[0-9]"), "uppers": _share(run, "[A-Z]"), "vowels": _share(F.lower(run), "[aeiou]"),
        "hex_only": flag(run.rlike("^[0-9a-fA-F]+$")), "coverage": covered,
        "slashes": (F.length(run) - F.length(F.translate(run, "/", ""))).cast("double"),
        "in_link": flag(word.rlike(r"(?i)[a-z]+://|www\.")), "in_path": flag(word.rlike(r"[/\\].*[/\\]|\.[a-z]{2,4}$")),
        "quoted": flag(word.rlike("[\"'`]")), "named_here": flag(word.rlike(NAMES)), "named_before": flag(before.rlike(NAMES)),
        "assigned": flag(word.rlike("[=:]") | F.col("before1").rlike("[=:]$")),
        "long_before": flag(F.col("before1").rlike(RUN)), "long_after": flag(F.col("after").rlike(RUN)),
    })


def label_by_format(found: DataFrame) -> DataFrame:
    """``found`` plus ``label``: 1, 0 or null, by published formats (see the module's text)."""
    before = F.concat_ws(" ", "before2", "before1", "word")
    key = F.col("run").rlike("^AKIA[0-9A-Z]{16}$")
    value = before.rlike(rf"{NAMED}\s*{IS}\s*\\?[\"'`]?[{CHARS}]{{{MIN_LABELLED},}}={{0,2}}\\?[\"'`]?[,;)}}\]]*$") & F.col("run").rlike("[0-9]")
    plain = (F.length("run") >= MIN_RUN) & (~F.col("run").rlike("[0-9]") | F.col("run").rlike("^[0-9]+$"))
    return found.withColumn("label", F.when(key | value, 1).when(plain, 0))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest of labelled findings (``FEATURES`` and ``label``), or None if a label has too few."""
    order = F.xxhash64("doc_id", "position", "word")
    picked = None
    for y in (0, 1):
        one = labelled.where(F.col("label") == y).select(
            order.alias("o"), F.col("label").cast("double").alias("label"), *FEATURES).orderBy("o", *FEATURES).limit(rows)
        picked = one if picked is None else picked.unionByName(one)
    # At most 2 * rows findings: one partition, so that the draw of each tree does not depend on the layout.
    picked = picked.repartition(1).sortWithinPartitions("o", *FEATURES).cache()
    try:
        n = {r.label: r["count"] for r in picked.groupBy("label").count().collect()}
        if min(n.get(0.0, 0), n.get(1.0, 0)) < MIN_ROWS:
            return None
        rows_ = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(picked)
        return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows_)
    finally:
        picked.unpersist()


def judge(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """Findings with ``p_secret`` and ``is_secret``."""
    if model is None:
        return found.withColumn("p_secret", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    return scored.withColumn("p_secret", vector_to_array("probability")[1]).withColumn("is_secret", F.col("p_secret") >= threshold)


def scan_secrets(df: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All findings with the forest's verdict; ``is_secret`` false marks those removed."""
    found = with_features(candidates(df, id_col, text_col, index=True), frequent_words(df, text_col))
    found = write_table(found, "findings")  # read by the samples of both labels and by the verdicts
    model = train(labelled if labelled is not None else label_by_format(found))
    return judge(found, model)


def secret_digest(df: DataFrame) -> DataFrame:
    return scan_secrets(df).select("doc_id", "position", "run_index", F.sha2("run", 256).alias("run_sha256"),
                                   F.length("run").cast("long").alias("run_length"), F.round("p_secret", 6).alias("p_secret"), "is_secret")
