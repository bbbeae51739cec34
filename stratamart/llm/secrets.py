"""Secret scans whose false positives a random forest removes, in DataFrame operations alone.

Patterns find every run of key-like characters that is long enough to be a secret, every value that a word
announces, and passwords in urls; most are words, names or numbers. The forest looks at length, character transitions, dictionary coverage, path and
neighbouring words, and is trained on labelled findings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import SPACE, seeded_key, stage

# Characters of a run that nothing announces, and of an announced value.
MIN_LENGTH, MIN_ANNOUNCED = 16, 6
# The bounded sample that the forest is fitted on: documents whose findings are labelled, findings of either label.
SAMPLE_DOCS = 20_000
SAMPLE_FINDINGS = 5_000
# Most frequent words of each language. At most so many words can each be 1/DICTIONARY of all words of
# their language, so every word that is as frequent as that is in the dictionary.
DICTIONARY = 500
TREES, DEPTH = 20, 8
NEIGHBOURHOOD = 60

# Words that announce a secret, words that deny one, and formats that providers use.
ANNOUNCING = "key|token|secret|passw|pwd|auth|bearer|credential|api"
DENYING = "example|sample|dummy|placeholder|changeme|test|fake"
PROVIDER_FORMATS = "AKIA[A-Z0-9]{16}|ASIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[bap]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
# Where an announced value starts; its last part is looked at first, which turns most places away.
SIGN = r"[=:]{1,3}>?\s{0,3}"
ASSIGNED = rf"(?<![^=:>\s\"'`])(?<={SIGN}[\"'`]?)(?<=(?i:{ANNOUNCING})[\p{{L}}\p{{N}}_.-]{{0,20}}[\"'`\])]{{0,2}}\s{{0,3}}{SIGN}"
# A value reaches to the quote that it starts with, or else to the next blank, less closing marks.
VALUES = [rf"{ASSIGNED}{q})[^\s{q}]{{{MIN_ANNOUNCED},}}(?={q})" for q in "\"'`"] + [
    rf"{ASSIGNED})(?![\"'`]|(?<=[=:])[=:>])\S{{{MIN_ANNOUNCED - 1},}}[^\s.,;:)\]}}>\"'`]"
]
# One pattern for each kind of candidate; a place may be found by several.
CANDIDATES = [
    rf"(?<![\p{{L}}\p{{N}}_+/-])[A-Za-z0-9_+/-]{{{MIN_LENGTH},}}+={{0,2}}(?![\p{{L}}\p{{N}}])",
    "|".join(VALUES),
    r"(?<=:)(?<=://[^\s/:@]{0,64}:)[^\s/]+(?=@[^\s/@])",
]
# What holds digits and is no secret unless it is announced: numbers and dates, UUIDs, hashes of usual lengths.
HARMLESS = (
    "[0-9][0-9_+/-]*|[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-]?[0-9_-]*Z?|"
    "(?i:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})"
)
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

IN_URL = "before rlike '://[^ /:@]{0,64}:$' and behind rlike '^@'"

FEATURES = ["length", "switches", "digits", "capitals", "distinct", "transitions", "covered", "tested_path",
            "path_depth", "announced", "denied", "assigned", "quoted", "in_url"]


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Every candidate: ``doc_id``, ``mark`` (a hash of the text), ``nth``, ``start`` (characters before it),
    ``value``, what stands before and behind it, and ``path``.

    Candidates are runs of MIN_LENGTH or more key-like characters, values of MIN_ANNOUNCED or more characters
    other than blanks after an announcing word and ``=`` or ``:``, and passwords in ``user:password@`` of urls.
    An announced value may hold a run; both are candidates then, unless they are the same."""
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(text).alias("mark"),
        F.col(text).alias("text"),
        (F.col(path).cast("string") if path else F.lit("")).alias("path"),
    )
    cut = rows.withColumns(
        {f"values{k}": F.regexp_extract_all("text", F.lit(c), F.lit(0)) for k, c in enumerate(CANDIDATES)}
    ).filter(" or ".join(f"size(values{k}) > 0" for k in range(len(CANDIDATES))))
    cut = cut.withColumns(
        {f"between{k}": F.when(F.expr(f"size(values{k}) > 0"), F.split("text", c, -1)) for k, c in enumerate(CANDIDATES)}
    )
    pieces = F.expr(
        "concat({})".format(
            ", ".join(
                f"transform(values{k}, (v, i) -> struct({k} as kind, i as turn, v as value, "
                f"right(between{k}[i], {NEIGHBOURHOOD}) as before, left(between{k}[i + 1], {NEIGHBOURHOOD}) as behind, "
                f"length(between{k}[i]) as gap))"
                for k in range(len(CANDIDATES))
            )
        )
    )
    so_far = Window.partitionBy("doc_id", "mark", "path", "kind").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.dropDuplicates(["doc_id", "mark", "path"])
        .select("doc_id", "mark", "path", F.explode(pieces).alias("piece"))
        .select("doc_id", "mark", "path", "piece.*")
        .withColumn("start", F.col("gap") + F.coalesce(F.sum(F.expr("gap + length(value)")).over(so_far), F.lit(0)))
        # What is found twice keeps the text before it that tells more.
        .groupBy("doc_id", "mark", "path", "start", "value")
        .agg(F.max(F.struct(F.length("before").alias("told"), "kind", "before", "behind")).alias("seen"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "mark", "path").orderBy("start", "value")) - 1)
        .select("doc_id", "mark", "path", "nth", "value", "seen.before", "seen.behind", "start")
    )


def character_rates(words: DataFrame) -> list[float]:
    """Log-probability of each letter after each letter in the words, 26 x 26 in a row."""
    pairs = (
        words.select("n", F.expr("transform(sequence(1, greatest(1, length(word) - 1)), i -> substr(word, i, 2))").alias("pairs"))
        .select("n", F.explode("pairs").alias("pair"))
        .filter("pair rlike '^[a-z]{2}$'")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .withColumn("rate", F.log((F.col("n") + 1) / (F.sum("n").over(Window.partitionBy(F.substring("pair", 1, 1))) + 26)))
    )
    known = {r["pair"]: r["rate"] for r in pairs.select("pair", "rate").collect()}
    least = min(known.values(), default=-6.0)
    return [known.get(a + b, least) for a in LOWER for b in LOWER]


def either_of(words: list[str]) -> str:
    """A pattern of the longest of the words at a place. Words that begin alike share their beginning in it,
    so that a place is tried in as many steps as a word has letters, however many words there are."""
    tree: dict = {}
    for word in words:
        at = tree
        for letter in word:
            at = at.setdefault(letter, {})
        at[""] = {}

    def below(at: dict) -> str:
        ways = [letter + below(at[letter]) for letter in sorted(at) if letter]
        return f"(?:{'|'.join(ways)}){'?' if '' in at else ''}" if ways else ""

    return below(tree) or "(?!)"


def with_features(found: DataFrame, rates: list[float], dictionary: list[str]) -> DataFrame:
    """FEATURES of every finding, as doubles. A pair of characters that are not both letters counts
    as unlikely as the least likely pair of letters."""
    table = ", ".join(f"{r:.4f}D" for r in rates)
    classes = f"translate(value, '{LOWER}{UPPER}{DIGITS}', '{'a' * 26}{'A' * 26}{'9' * 10}')"
    words = either_of(dictionary)
    place = "(ascii(substr(low, i, 1)) - 97) * 26 + ascii(substr(low, i + 1, 1)) - 97"
    letters = "ascii(substr(low, i, 1)) between 97 and 122 and ascii(substr(low, i + 1, 1)) between 97 and 122"
    return (
        found.withColumns({"low": F.lower("value"), "draw": F.expr("pmod(xxhash64(value, doc_id, mark, path, nth), 1048576) / 1048576D")})
        .withColumns(
            {
                "length": F.expr("length(value)"),
                "switches": F.expr(f"length(regexp_replace({classes}, '(.)\\\\1+', '$1')) / length(value)"),
                "digits": F.expr(f"(length(value) - length(translate(value, '{DIGITS}', ''))) / length(value)"),
                "capitals": F.expr(f"(length(value) - length(translate(value, '{UPPER}', ''))) / length(value)"),
                "distinct": F.expr("size(array_distinct(split(value, ''))) / length(value)"),
                "transitions": F.expr(
                    f"aggregate(sequence(1, greatest(1, length(low) - 1)), 0D, (sum, i) -> sum + if({letters}, "
                    f"element_at(array({table}), {place} + 1), {min(rates):.4f}D)) / greatest(1, length(low) - 1)"
                ),
                "covered": F.expr(f"1 - length(regexp_replace(low, '{words}', '')) / length(low)"),
                "tested_path": F.expr(f"coalesce(lower(path), '') rlike '{DENYING}|doc'"),
                "path_depth": F.expr("length(path) - length(replace(path, '/', ''))"),
                "announced": F.lower("before").rlike(rf"({ANNOUNCING})\S*[\s=:>\"'`]{{0,8}}$"),
                "denied": F.expr(f"lower(concat(before, ' ', low, ' ', behind)) rlike '{DENYING}'"),
                "assigned": F.expr("before rlike '[=:] ?[\"`]?$'"),
                "quoted": F.expr("before rlike '[\"`]$' and behind rlike '^[\"`]'"),
                "in_url": F.expr(IN_URL),
            }
        )
        .withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """Labels for findings that need no judgement: formats of providers, passwords in urls and announced values
    with digits are secrets; runs of letters with at most one capital are not, nor are numbers, dates, UUIDs and
    hashes that nothing announces; the others stay open."""
    announced = F.lower("before").rlike(rf"({ANNOUNCING})\S*[\s=:>\"'`]{{1,8}}$")
    return found.withColumn(
        "label",
        F.when(F.col("value").rlike(f"^({PROVIDER_FORMATS})$") | F.expr(IN_URL), 1.0)
        .when(announced & F.col("value").rlike("[0-9]"), 1.0)
        .when(F.col("value").rlike("^[A-Za-z]?[a-z_+/-]*$"), 0.0)
        .when(~announced & F.col("value").rlike(f"^({HARMLESS})$"), 0.0),
    )


def planted(sample: DataFrame) -> DataFrame:
    """Labelled findings that no rule decides: into every document of a sample (``doc_id``, ``text``, ``path``) a key
    and a look-alike are put between its words, where nothing announces them. Keys are made of digests in the
    alphabets that keys come in; look-alikes are names made of the document's own words, as code and file systems
    have them. A word of the document also is the password in a url."""
    digest = lambda turn: f"base64(unhex(sha2(concat('planted-{turn}:', coalesce(string(doc_id), text)), 256)))"
    long = f"regexp_replace(concat({digest(1)}, {digest(2)}), '=', '')"
    bits = "pmod(xxhash64('planted', doc_id, text), 1024)"
    capital = "transform(names, w -> initcap(w))"
    made = (
        sample.withColumns({"bits": F.expr(bits), "names": F.expr("regexp_extract_all(lower(text), '[a-z]{3,}', 0)")})
        .filter("size(names) >= 8")
        .withColumn("names", F.expr("slice(names, int(1 + bits % greatest(1, size(names) - 6)), int(4 + bits % 3))"))
        .withColumns(
            {
                "key": F.expr(
                    f"substr(case bits % 4 when 0 then {long} when 1 then translate({long}, '+/', '-_') "
                    f"when 2 then upper(regexp_replace({long}, '[^A-Za-z2-7]', '')) "
                    f"else regexp_replace({long}, '[+/]', '') end, 1, int(20 + bits % 21))"
                ),
                "alike": F.expr(
                    f"case bits div 4 % 5 when 0 then array_join({capital}, '') when 1 then array_join(names, '_') "
                    f"when 2 then array_join(names, '/') when 3 then concat(array_join(names, '-'), '-', bits % 100) "
                    f"else concat(get(names, 0), array_join(slice({capital}, 2, 9), ''), bits % 10) end"
                ),
                "head": F.expr("substring_index(text, ' ', int(1 + bits % 12))"),
            }
        )
        .filter(f"length(alike) >= {MIN_LENGTH} and alike not rlike '^[A-Za-z]?[a-z_+/-]*$'")
        .withColumn("text", F.expr("concat(head, ' ', key, ' ', alike, ' db://', get(names, 0), ':', get(names, 1), '@host ', substr(text, length(head) + 2))"))
    )
    marked = made.select("doc_id", F.xxhash64("text").alias("mark"), "key", "alike", F.expr("get(names, 1)").alias("word")).distinct().alias("m")
    same = F.expr("f.doc_id <=> m.doc_id and f.mark = m.mark and f.value in (m.key, m.alike, m.word)")
    found = findings(made, path="path").alias("f")
    return found.join(marked, same).select("f.*", F.expr("double(f.value <> m.alike)").alias("label"))


@dataclass(frozen=True)
class Scanner:
    rates: list[float]
    dictionary: list[str]
    forest: PipelineModel | None


def bounded(labelled: DataFrame) -> DataFrame:
    """About SAMPLE_FINDINGS rows of each label, or all if there are fewer, by the evenly spread column ``draw``."""
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    keep = F.lit(False)
    for label, n in counts.items():
        keep = keep | ((F.col("label") == label) & (F.col("draw") < min(1.0, SAMPLE_FINDINGS / n)))
    return labelled.filter(keep)


def sampled(docs: DataFrame, key: str, text: str, path: str | None) -> DataFrame:
    """``doc_id``, ``text`` and ``path`` of some SAMPLE_DOCS documents, or of all if there are fewer."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    return stage(
        docs.filter(seeded_key(F.col(key), "secrets-1") < int(share * 2**52)).select(
            F.col(key).alias("doc_id"), F.col(text).alias("text"), (F.col(path) if path else F.lit("")).alias("path")
        ),
        "secrets-sample",
    )


def train(docs: DataFrame, labelled: DataFrame | None = None, key: str = "doc_id", text: str = "text",
          path: str | None = None, lang: str | None = None) -> Scanner:
    """A scanner from the words and pairs of letters of all documents, and a bounded sample of some
    SAMPLE_FINDINGS findings of each label. Of each value of the column ``lang`` the DICTIONARY most frequent words
    are known; without it, of all documents together. ``labelled`` has the columns of ``findings`` and ``label``
    (0 or 1); without it, findings of some SAMPLE_DOCS documents are labelled by ``weak_labels``, and keys and
    look-alikes ``planted`` among their words, which teach what no rule decides. With findings
    of only one label there is nothing to learn, and no finding is removed."""
    words = stage(
        docs.select(
            (F.col(lang).cast("string") if lang else F.lit("")).alias("lang"),
            F.explode(F.split(F.lower(text), SPACE)).alias("word"),
        )
        .filter("word rlike '^[a-z]+$'")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n")),
        "secrets-words",
    )
    # Few rows of each task reach the window: limits of ranks are applied before the shuffle too.
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    frequent = (
        words.filter("length(word) >= 3").withColumn("turn", F.row_number().over(most)).filter(F.col("turn") <= DICTIONARY)
    )
    dictionary = sorted(r["word"] for r in frequent.select("word").distinct().collect())
    rates = character_rates(words)
    if labelled is None:
        sample = sampled(docs, key, text, path)
        labelled = weak_labels(findings(sample, path="path")).filter("label is not null")
        labelled = labelled.unionByName(planted(sample))
    known = bounded(stage(with_features(labelled, rates, dictionary).select("label", "draw", *FEATURES), "secrets-labelled"))
    if known.select("label").distinct().count() < 2:
        return Scanner(rates, dictionary, None)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=4, featuresCol="features", labelCol="label")
    fitted = forest.fit(assembler.transform(known))
    return Scanner(rates, dictionary, PipelineModel([assembler, fitted]))


def scan(docs: DataFrame, scanner: Scanner, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id``, ``start``, ``value``, ``probability`` and ``secret`` for every finding in ``docs``.

    Whole texts are searched; null and empty texts have no findings. Rows with equal ids, texts and paths
    are searched once, those of different paths each for its own; null ids are values like others. Columns that are not named are not looked at.
    """
    found = with_features(findings(docs, key, text, path), scanner.rates, scanner.dictionary)
    if scanner.forest is None:
        judged = found.withColumn("chance", F.lit(1.0))
    else:
        judged = scanner.forest.transform(found).withColumn("chance", vector_to_array("probability")[1])
    return judged.select(
        "doc_id", "start", "value", F.round("chance", 6).alias("probability"), (F.col("chance") >= 0.5).alias("secret")
    )
