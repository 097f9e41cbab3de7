"""Secret scanning with a random forest that removes false positives.

Candidates are long runs of the characters that keys are made of, and every value that follows the
name of a secret and an assignment, whatever its length and punctuation. Features say how
long a candidate is, how its characters change between letters, digits,
cases, vowels and consonants, how much of it dictionary words cover, what its path looks like, and
which words stand around it. A forest trained on labelled findings gives each
candidate the chance of being a secret. Everything runs as DataFrame functions and the library's forest.

The forest is fitted on a bounded sample: ``TRAIN_ROWS`` different labelled findings per label, those with
the lowest hashes; a finding that many documents repeat counts once. The dictionary holds the ``DICTIONARY_WORDS`` most frequent
plain words of the whole text column. Both bounds are parameters.

Where no reviewer's labels are given, ``label_by_format`` labels what is beyond doubt: known key
formats and assignments to a name like ``password`` are secrets, except short values of letters only or digits
only, which stay without a label; placeholders after such a name are not secrets. Nor are, without such a name, runs
of letters only or digits only and what looks like a hash, a UUID or words and numbers with separators. The
forest decides the rest. A known format is a secret whatever the forest says, and so is a mixed value assigned
to such a name, unless a reviewer's labels taught the forest otherwise.

Defined cases. A NULL or empty text has no candidates. A NULL path has no path
features. A quoted value after a name and an assignment ends at its quote and counts as one word, spaces
included; others end at a space, less closing brackets, quotes, commas and semicolons. Such a value shorter than
``MIN_LENGTH`` is redacted only where it follows a name and an assignment, others wherever they occur. The
noncharacters U+FDD0 to U+FDD7 end a value. Without labelled findings of both kinds there is no forest: then only known formats
and mixed values assigned to a name are secrets, with score 1, and all others score 0. Repeated rows give repeated findings. An
empty table gives an empty result. The input's columns travel in one struct in ``redact``; only the
named columns are read elsewhere, so other columns cannot clash.
"""

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens.llm.tables import whole_row
from ludolens.operators.ordering import top_k
from ludolens.scratch import broadcast_small, write_scratch

MIN_LENGTH = 16
THRESHOLD = 0.5
TRAIN_ROWS = 10_000
DICTIONARY_WORDS = 300
TREES, DEPTH, SEED = 20, 6, 7
REDACTED = "[SECRET]"

# Key formats, names of secrets and paths of examples.
CANDIDATE = rf"[A-Za-z0-9_+/\-]{{{MIN_LENGTH},}}"
KNOWN_FORMATS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9\-]{10,}|sk_live_[A-Za-z0-9]{16,})$"
PLACEHOLDERS = r"(?i)^(?:null|none|nil|true|false|undefined|[*x.]+|<[^>]*>?|\$?\{.*|%\(.*)$"
# Hashes and UUIDs; words and numbers joined by separators have these, but none of the changes after them.
HASHES = (
    r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}"
    r"|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})$"
)
JOINED = r"^[A-Za-z0-9]+[\-_/+]"
TANGLED = r"[0-9][A-Za-z]|[a-z][A-Z]|[A-Z]{2}[a-z]|[A-Za-z]{2}[0-9]|[A-Za-uw-z][0-9]"
# A named value of letters only or digits only is a secret beyond doubt from this length on.
NAMED_LENGTH = 8
SECRET_NAMES = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key|auth|bearer|credential)"
# A name as a whole word or in front of a suffix (tokens, PASSWORD_PROD, authToken), what assigns, and the value.
_NAME_ENDS = r"(?:orization|entication|s)?(?![a-z])|(?-i:(?<=[a-z])[A-Z])|(?=[_\-.0-9])"
ASSIGNMENT = r"(?::{1,2}=|[=:]>|={1,3}|:)\s*(?:(?:bearer|basic|token)\s+)?\\?[\"'`]?"
_INSIDE = r"[^\n\uFDD0-\uFDD7]+?(?<!\\)"
VALUE = (
    rf"(?:(?<=\"){_INSIDE}(?=\")|(?<='){_INSIDE}(?=')|(?<=`){_INSIDE}(?=`)"
    r"|[^\s\uFDD0-\uFDD7]*[^\s\uFDD0-\uFDD7,;)\]}\"'`])"
)
NAMED = (
    rf"({SECRET_NAMES}(?:{_NAME_ENDS})[\w\-.]{{0,64}}\\?[\"'`]?\]?\s*{ASSIGNMENT})(?![\"'`])({VALUE})"
)
EXAMPLE_PATHS = r"(?i)(?:test|example|sample|mock|fixture|doc)"
SPACES = r"[\x20\x09-\x0D]+"

# Stand in a copy of the text for spaces inside a value, and for its begin and end.
_BLANKS, _HIDDEN, _BEGIN, _END = " \t\n\x0b\x0c\r", "\ufdd0\ufdd1\ufdd2\ufdd3\ufdd4\ufdd5", "\ufdd6", "\ufdd7"

FEATURES = [
    "length",
    "letter_digit_changes",
    "case_changes",
    "vowel_changes",
    "digit_share",
    "upper_share",
    "distinct_share",
    "dictionary_coverage",
    "path_depth",
    "example_path",
    "secret_name_before",
    "assigned",
    "quoted",
    "plain_word_after",
]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _with_values(text: Column, change: Callable[[Column], Column]) -> Column:
    """``text`` with ``change`` made to every value that follows a name and an assignment."""
    pattern = F.lit(NAMED)
    parts = F.arrays_zip(
        F.split(text, NAMED).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("name"),
        F.regexp_extract_all(text, pattern, F.lit(2)).alias("value"),
    )
    # The last gap has no value after it.
    joined = F.transform(
        parts,
        lambda p: F.when(p["name"].isNull(), p["gap"]).otherwise(F.concat(p["gap"], p["name"], change(p["value"]))),
    )
    return F.when(text.rlike(NAMED), F.array_join(joined, "")).otherwise(text)


def _shown(text: Column) -> Column:
    return F.translate(text, _HIDDEN + _BEGIN + _END, _BLANKS)


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """key, digest of the text, path, word_no, candidate and the words around it, one row per candidate."""
    words = docs.select(
        F.col(key).alias("key"),
        F.md5(F.col(text).cast("binary")).alias("digest"),
        F.col(path).cast("string").alias("path"),
        F.split(
            _with_values(F.col(text), lambda v: F.concat(F.lit(_BEGIN), F.translate(v, _BLANKS, _HIDDEN), F.lit(_END))),
            SPACES,
        ).alias("words"),
    ).where(F.col("words").isNotNull())
    places = F.filter(
        F.sequence(F.lit(1), F.size("words")), lambda i: F.element_at("words", i).rlike(f"{CANDIDATE}|{_BEGIN}")
    )
    found = words.where(F.col("words")[0].isNotNull()).select("key", "digest", "path", "words", F.explode(places).alias("word_no"))
    around = lambda step: F.coalesce(F.try_element_at("words", F.nullif(F.greatest(F.col("word_no") + step, F.lit(0)), F.lit(0))), F.lit(""))
    placed = found.select(
        "key",
        "digest",
        "path",
        "word_no",
        F.element_at("words", F.col("word_no")).alias("marked"),
        _shown(F.element_at("words", F.col("word_no"))).alias("word"),
        _shown(F.concat_ws(" ", around(-2), around(-1))).alias("words_before"),
        _shown(around(1)).alias("word_after"),
    )
    # What stands in a value is not a candidate besides it.
    value = f"{_BEGIN}([^{_END}]*){_END}"
    named = F.transform(
        F.regexp_extract_all("marked", F.lit(value), F.lit(1)),
        lambda v: F.struct(_shown(v).alias("candidate"), F.concat(F.lit(_BEGIN), v).alias("_at")),
    )
    rest = F.regexp_replace("marked", value, " ")
    runs = F.transform(
        F.regexp_extract_all(rest, F.lit(CANDIDATE), F.lit(0)), lambda v: F.struct(v.alias("candidate"), v.alias("_at"))
    )
    inside = F.inline(F.array_distinct(F.concat(named, runs)))
    return (
        placed.select("*", inside)
        .withColumn("before", F.concat_ws(" ", "words_before", _shown(F.expr("substring_index(marked, _at, 1)"))))
        .drop("marked", "_at")
    )


def dictionary(docs: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent plain words of 3 to 12 letters, equal counts by name."""
    plain = F.filter(F.split(F.lower(F.col(text)), SPACES), lambda w: w.rlike("^[a-z]{3,12}$"))
    counts = docs.select(F.explode(plain).alias("word")).groupBy("word").count()
    return [r["word"] for r in counts.orderBy(F.desc("count"), "word").limit(words).collect()]


def with_features(found: DataFrame, known_words: list[str]) -> DataFrame:
    value, length = F.col("candidate"), F.length("candidate").cast("double")
    longest_first = "|".join(sorted(known_words, key=lambda w: (-len(w), w)))
    rest = F.length(F.regexp_replace(F.lower(value), longest_first, "")) if known_words else length
    made = {
        "length": F.log2(length),
        "letter_digit_changes": _count(value, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])") / length,
        "case_changes": _count(value, "[a-z](?=[A-Z])|[A-Z](?=[a-z])") / length,
        "vowel_changes": _count(value, "(?i)[aeiouy](?=[b-df-hj-np-tv-xz])|[b-df-hj-np-tv-xz](?=[aeiouy])") / length,
        "digit_share": _count(value, "[0-9]") / length,
        "upper_share": _count(value, "[A-Z]") / length,
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))).cast("double") / length,
        "dictionary_coverage": 1.0 - rest / length,
        "path_depth": F.coalesce(_count(F.col("path"), "[/\\\\]"), F.lit(0.0)),
        "example_path": F.coalesce(F.col("path").rlike(EXAMPLE_PATHS), F.lit(False)).cast("double"),
        "secret_name_before": F.col("before").rlike(SECRET_NAMES).cast("double"),
        "assigned": F.col("before").rlike(f"(?i){ASSIGNMENT}$").cast("double"),
        "quoted": F.col("word").rlike("[\"'`]").cast("double"),
        "plain_word_after": F.col("word_after").rlike("^[A-Za-z]+[.,]?$").cast("double"),
    }
    return found.select("*", *[made[name].alias(name) for name in FEATURES])


def _mixed() -> Column:
    return F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")


def _named() -> Column:
    return (F.col("secret_name_before") > 0) & (F.col("assigned") > 0)


def _certain() -> Column:
    """Known formats, and mixed values assigned to the name of a secret."""
    value = F.col("candidate")
    return value.rlike(KNOWN_FORMATS) | (_named() & _mixed() & ~value.rlike(PLACEHOLDERS))


def label_by_format(found: DataFrame) -> DataFrame:
    """Add ``label``: 1.0 or 0.0 where the format leaves no doubt, otherwise NULL."""
    value = F.col("candidate")
    identifier = value.rlike(HASHES) | (value.rlike(JOINED) & ~value.rlike(TANGLED))
    label = (
        F.when(_certain(), 1.0)
        .when(_named(), F.when(value.rlike(PLACEHOLDERS), 0.0).when(F.length(value) >= NAMED_LENGTH, 1.0))
        .when(~_mixed(), 0.0)
        .when((F.col("secret_name_before") == 0) & identifier, 0.0)
    )
    return found.withColumn("label", label)


def train(labelled: DataFrame, rows_per_label: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest fitted on labelled findings with features, or None if a label is missing."""
    known = labelled.where("label is not null").withColumn("_rank", F.xxhash64("candidate", "before", "word_after"))
    # Repeated findings count once. The rest is cut roughly first, then to the lowest hashes.
    counts = known.groupBy("label").agg(F.approx_count_distinct("_rank").alias("n"))
    different = {r["label"]: r["n"] for r in counts.collect()}
    if set(different) != {0.0, 1.0}:
        return None
    shares = F.create_map(*[F.lit(x) for k, n in different.items() for x in (k, min(1.0, 2 * rows_per_label / n))])
    low = known.where(F.pmod("_rank", F.lit(1 << 30)) < shares[F.col("label")] * (1 << 30))
    order = [F.pmod("_rank", F.lit(1 << 30)), F.col("_rank"), *FEATURES]
    once = write_scratch(low.select("label", "_rank", *FEATURES).dropDuplicates(["label", "_rank", *FEATURES]))
    lowest = top_k(once, rows_per_label, order, within=["label"], name="_place")
    sample = write_scratch(lowest.select("label", *FEATURES))
    taken = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(taken) < 2:
        return None
    weight = F.when(F.col("label") > 0, sum(taken.values()) / (2 * taken[1.0])).otherwise(
        sum(taken.values()) / (2 * taken[0.0])
    )
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="_weight", featuresCol="_features"
    )
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(sample.withColumn("_weight", weight))
    return forest.fit(assembled.select("label", "_features", "_weight"))


def score(
    found: DataFrame, model: RandomForestClassificationModel | None, keep_named: bool = True
) -> DataFrame:
    """Add ``score``, the chance of being a secret; 1 for known formats and, if kept, mixed named values."""
    certain = (_certain() if keep_named or model is None else F.col("candidate").rlike(KNOWN_FORMATS)).cast("double")
    if model is None:
        return found.withColumn("score", certain)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(found)
    chance = vector_to_array("probability")[1]
    scored = model.transform(assembled).withColumn("score", F.greatest(chance, certain))
    return scored.select(*found.columns, "score")


def scan(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    labelled: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    path: str = "source",
) -> DataFrame:
    """Every candidate with its features, score and ``is_secret``.

    ``labelled`` holds findings with the columns of ``with_features`` and a ``label``.
    """
    found = write_scratch(with_features(candidates(docs, key, text, path), dictionary(docs, text)))
    model = train(labelled if labelled is not None else label_by_format(found))
    return score(found, model, keep_named=labelled is None).withColumn("is_secret", F.col("score") >= threshold)


def redact(
    docs: DataFrame,
    findings: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: str = "n_chars",
    mark: str = REDACTED,
) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``length`` set anew where the text changed."""
    values = (
        findings.where("is_secret")
        .groupBy("key", "digest")
        .agg(F.collect_set("candidate").alias("values"))
        .select(F.col("key").alias("_key"), F.col("digest").alias("_digest"), "values")
    )
    digest = F.md5(F.col(text).cast("binary"))
    rows = docs.select(whole_row(docs), F.col(key).alias("_row_key"), digest.alias("_row_digest"))
    same = F.col("_row_key").eqNullSafe(F.col("_key")) & (F.col("_row_digest") == F.col("_digest"))
    placed = _with_values(
        F.col(f"row.{text}"), lambda v: F.when(F.array_contains("values", v), F.lit(mark)).otherwise(v)
    )
    # A short value may be part of any word elsewhere.
    anywhere = F.filter("values", lambda v: F.length(v) >= MIN_LENGTH)
    longest_first = F.array_sort(anywhere, lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(longest_first, placed, lambda t, v: F.replace(t, v, F.lit(mark)))
    joined = rows.join(broadcast_small(write_scratch(values)), same, "left").withColumn(
        "_clean", F.when(F.col("values").isNull(), F.col(f"row.{text}")).otherwise(clean)
    )
    changed = F.col("values").isNotNull()
    columns = {text: F.col("_clean")}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        old = F.col(f"row.`{length}`")
        columns[length] = F.when(changed, F.length("_clean").cast(kind)).otherwise(old)
    return joined.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
