"""Secret scans with a random forest (operator 3), with DataFrame operations only.

A text is split at its candidates: runs of LEAST or more characters of keys and codes, and values of SHORT or more characters
of any kind that a credential name and an assignment precede. Names and values are apart, because an assignment ends a run.
Features are the length, character transitions and shares, how much the dictionary covers (the WORDS most frequent words of
the whole table), whether the candidate is part of a path or address, has the form of a UUID or is itself the name in an
assignment, and the neighbouring words of the CONTEXT characters before, the candidate before included. A forest
trained on labelled findings then removes false positives. Its trees become nested conditions over the feature columns, so
a document is scored within its own row: no candidate is shuffled and no text is joined back.

The forest is trained on a bounded number of different labelled findings, TRAINING of each kind, picked by a hash. Where no labelled
table is given, findings label themselves only where it is plain: assigned, quoted and named as a credential and a mixture
of letters and digits (secret), or nothing but letters or digits, a path, a name, or announced as a hash or id (none). What is plain by
its characters is learned once more without its neighbouring words, so the forest knows secrets by their characters as well.
Added are `examples`: EXAMPLES findings of each of the kinds that look alike (hashes, UUIDs, addresses, paths, names on
one side, keys and passwords on the other), made from a rule and labelled by how they were made, so that a table that
lacks a kind does not leave the forest without it.

Defined cases: null and empty texts have no candidates; equal rows are judged alike; with a table of labelled findings of one
kind only, the plain rule decides; candidates of any length are judged whole; an empty table gives an empty result; extra
columns of any name travel along.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.columns import fresh
from skyledger.sources.tables import stage

LEAST, SHORT = 16, 6
NAMED = r"(?i:token|secret|passwo?r?d|passphrase|pwd|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential)"
ASSIGNED = r"[\"'`]?[ \t]{0,2}[:=][ \t]{0,2}[\"'`]?"
# The first look behind is one character long and rules nearly every place out before the longer one is tried.
VALUE = rf"(?<=[:=\s\"'`])(?<={NAMED}{ASSIGNED})[^\s\"'`,;:=][^\s\"'`,;]{{{SHORT - 1},}}"
RUN = rf"(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{{{LEAST},}}(?:={{1,2}}(?![A-Za-z0-9_+/=\-]))?"
CANDIDATE = f"{VALUE}|{RUN}"
CREDENTIAL = r"(token|secret|passw|pwd|passphrase|api.?key|access.?key|auth|bearer|credential|private)[^\p{L}\p{N}\n]{0,6}$"
ANNOUNCED = r"\b(commit|sha-?[0-9]*|hash|md5|checksum|digest|revision|rev|etag|uuid|guid|blob|tree|parent|merge|id)[^\p{L}\p{N}\n]{0,6}$"
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
ADDRESS = r"(://\S*|[/.\\])$"  # what stands before a part of a path or address
SEGMENTS = r"^/?([A-Za-z_\-]{2,}/){2}"  # two or more folders
CHANGE = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Za-z0-9])(?=[_+/=\-])"
CONTEXT = 80
WORDS = 256
TRAINING = 2000
EXAMPLES = 300
TREES, DEPTH = 15, 6
MASK = "[SECRET]"
NEIGHBOURS = ("credential", "assigned", "quoted")
FEATURES = ("length", "changes", "digits", "upper", "symbols", "variety", "coverage", "path", "uuid", "name", "announced", *NEIGHBOURS)


def dictionary(docs: DataFrame, words: int = WORDS) -> list[str]:
    """The most frequent words of three letters or more, counted over every text; at most `words` reach the driver."""
    every = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where(F.length("word") >= 3)
    top = every.groupBy("word").count().orderBy(F.desc("count"), "word").limit(words).collect()
    return sorted((r["word"] for r in top), key=lambda w: (-len(w), w))


def share_of(text: Column, pattern: str) -> Column:
    return (1 - F.length(F.regexp_replace(text, pattern, "")) / F.length(text)).cast("double")


def features(found: Column, before: Column, after: Column, known: list[str]) -> Column:
    """The feature struct of one candidate."""
    number = lambda c: c.cast("double")
    start, rest = F.lower(before), F.left(after, F.lit(4))
    known_words = "|".join(known) or r"\z\A"  # letters only, longest first
    return F.struct(
        number(F.length(found)).alias("length"),
        (number(F.regexp_count(found, F.lit(CHANGE))) / F.length(found)).alias("changes"),
        share_of(found, "[0-9]").alias("digits"),
        share_of(found, "[A-Z]").alias("upper"),
        share_of(found, "[A-Za-z0-9]").alias("_plain"),
        (number(F.size(F.array_distinct(F.split(found, "")))) / F.length(found)).alias("variety"),
        share_of(F.lower(found), known_words).alias("coverage"),
        number(F.regexp_like(start, F.lit(ADDRESS)) | F.regexp_like(found, F.lit(SEGMENTS))).alias("path"),
        number(F.regexp_like(found, F.lit(UUID))).alias("uuid"),
        number(F.regexp_like(found, F.lit("^[A-Za-z_][A-Za-z0-9_]*=?$")) & (F.regexp_like(rest, F.lit(r"^[\"'`]?[ \t]{0,2}[=:]")) | F.endswith(found, F.lit("=")))).alias("name"),
        number(F.regexp_like(start, F.lit(ANNOUNCED))).alias("announced"),
        number(F.regexp_like(start, F.lit(CREDENTIAL))).alias("credential"),
        number(F.regexp_like(start, F.lit(r"[=:]\s*[\"'`]?$"))).alias("assigned"),
        number(F.regexp_like(start, F.lit("[\"'`]$")) & F.regexp_like(rest, F.lit("^[\"'`]"))).alias("quoted"),
    )


def scanned(docs: DataFrame, known: list[str], name: str) -> DataFrame:
    """The input rows and a column with the texts between candidates and the candidates with their features."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    between, found = F.split(text, CANDIDATE, -1), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    parts = F.struct(between.alias("between"), found.alias("found"))
    split = docs.withColumn(name, F.when(F.regexp_like(text, F.lit(CANDIDATE)), parts).otherwise(F.struct(F.array(text).alias("between"), F.array().cast("array<string>").alias("found"))))
    cell = F.col(name)
    # Each candidate meets its surroundings first, so that what is computed for one reads nothing outside of it.
    n = F.size(cell["found"])
    last = lambda c: F.right(c, F.lit(CONTEXT))
    before = F.zip_with(F.slice(F.concat(F.array(F.lit("")), cell["found"]), 1, n), F.slice(cell["between"], 1, n), lambda c, b: last(F.concat(last(c), last(b))))
    around = F.zip_with(before, F.slice(cell["between"], 2, n), lambda b, a: F.struct(b.alias("before"), F.left(a, F.lit(4)).alias("after")))
    judged = F.zip_with(cell["found"], around, lambda c, s: F.struct(c.alias("text"), features(c, s["before"], s["after"], known).alias("of")))
    tidy = F.transform(judged, lambda c: F.struct(c["text"].alias("text"), F.struct(*[(1 - c["of"]["_plain"] if f == "symbols" else c["of"][f]).alias(f) for f in FEATURES]).alias("of")))
    return split.withColumn(name, F.struct(cell["between"].alias("between"), tidy.alias("found")))


def plain_characters(of: Column) -> Column:
    return (of["digits"] == 0) & (of["symbols"] == 0) & (of["upper"] < 0.2) | (of["digits"] == 1)


def plain_label(of: Column) -> Column:
    """1 for findings that are plainly secrets, 0 for those that plainly are not, null where nothing is plain."""
    elsewhere = (of["path"] == 1) | (of["name"] == 1) | (of["announced"] == 1)
    mixed = (of["digits"] > 0.1) & (of["digits"] < 0.9) & (of["variety"] > 0.2)
    named = (of["credential"] == 1) & (of["assigned"] == 1) & (of["quoted"] == 1) & ~elsewhere
    return F.when(named & mixed, 1.0).when((elsewhere | plain_characters(of)) & (of["credential"] == 0) | (of["name"] == 1), 0.0)


def with_bare(labelled: DataFrame) -> DataFrame:
    """The findings, and those that their characters tell once more without neighbouring words."""
    told = (F.col("label") == 1) | (F.col("path") + F.col("name") + F.col("announced") == 0)
    return labelled.union(labelled.where(told).withColumns({n: F.lit(0.0) for n in NEIGHBOURS}))


def labelled_findings(docs: DataFrame, known: list[str], training: int = TRAINING) -> DataFrame:
    """(label, features): at most `training` different plain findings of each kind, and bare ones."""
    name = fresh(docs, "_scan")
    # explode_outer: explode would add a filter on the size of the array and compute it twice.
    rows = scanned(docs.select("text"), known, name).select(F.explode_outer(F.col(f"{name}.found")).alias("c"))
    rows = rows.select(plain_label(F.col("c.of")).alias("label"), F.xxhash64("c").alias("h"), "c.of.*").where("label IS NOT NULL")
    rows = rows.distinct()  # equal findings are one example, however often they are repeated
    place = F.row_number().over(Window.partitionBy("label").orderBy("h"))  # the limit is applied before the shuffle
    picked = stage(rows.withColumn("place", place).where(F.col("place") <= training).drop("place"), "findings")
    return with_bare(picked.select("label", *FEATURES))


def examples(spark: SparkSession, known: list[str], each: int = EXAMPLES) -> DataFrame:
    """(label, features) of made findings: `each` of every kind, from digests of their numbers and a few plain words."""
    n = F.col("id").cast("string")
    digest = lambda salt: F.sha2(F.concat(n, F.lit(salt)), 256)
    part = lambda salt, start, length: F.substring(digest(salt), start, length)
    code = lambda salt, length: F.substring(F.translate(F.base64(F.unhex(digest(salt))), "=", "7"), 1, length)
    pick = lambda salt, words: F.element_at(F.array(*map(F.lit, words)), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(words))).cast("int") + 1)
    word = lambda salt: pick(salt, ("main", "source", "example", "service", "reader", "common", "project", "tests", "module", "index", "report", "static"))
    hexes = F.substring(digest("hex"), 1, pick("len", (20, 32, 40, 64)))
    uuid = F.concat_ws("-", part("u", 1, 8), part("u", 9, 4), part("u", 13, 4), part("u", 17, 4), part("u", 21, 12))
    named = pick("name", ("password", "db_password", "api_key", "client_secret", "ACCESS_TOKEN", "AWS_SECRET_ACCESS_KEY"))
    equals = pick("eq", (" = ", ": ", "=", ":"))
    quote = pick("quote", ("\"", "'"))
    password = F.concat(code("p", 5), pick("mark", ("!", "#", "$", "%", "", "", ".", "@")), code("q", 3), pick("more", ("", "4", "x9", "Tr0ub")))
    folders = F.concat_ws("/", F.lit("src"), word("a"), word("b"), word("c"), F.initcap(word("d")))
    texts = {
        0.0: (F.concat(pick("an", ("commit ", "sha1: ", "merge ", "checksum = ", "digest: \"", "etag=\"", "rev ")), hexes, quote),
              F.concat(F.lit("https://"), word("a"), F.lit(".org/"), word("b"), F.lit("/"), hexes),
              F.concat(F.lit("https://"), word("a"), F.lit(".org/"), word("b"), F.lit("."), hexes), uuid, F.concat(F.lit("id: "), uuid),
              folders, F.concat(F.lit("/"), folders, F.lit("."), word("e")), F.concat_ws("_", word("a"), word("b"), word("c")),
              F.concat_ws("-", word("a"), word("b"), word("c"), part("v", 1, 2)),
              F.concat(F.upper(F.concat_ws("_", word("a"), F.lit("SECRET"), word("b"), F.lit("KEY"))), equals, quote),
              F.concat(named, equals, pick("plain", ("required", "changeme", "undefined", "optional", "hidden", "getPassword()"))),
              F.concat(F.lit("the "), word("a"), word("b"), word("c"), word("d")), F.concat(F.lit("no. "), F.conv(part("n", 1, 14), 16, 10))),
        1.0: (F.concat(named, equals, quote, hexes, quote), F.concat(named, equals, hexes), F.concat(named, equals, quote, code("k", 40), quote),
              F.concat(named, equals, code("k", 32)), F.concat(named, equals, quote, uuid, quote), F.concat(named, equals, quote, password, quote),
              F.concat(named, equals, password), F.concat(F.lit("Bearer "), code("k", 40)), F.concat(F.lit("see "), hexes), F.concat(word("a"), F.lit(" "), code("k", 40))),
    }
    # The finding is the last candidate of its text: names come before their values.
    made = F.array(*(F.struct(F.lit(label).alias("label"), text.alias("text")) for label, kinds in texts.items() for text in kinds))
    rows = scanned(spark.range(each).select(F.explode(made).alias("m")).select("m.label", "m.text"), known, "_scan")
    return rows.where(F.size("_scan.found") > 0).select("label", F.element_at("_scan.found", -1)["of"].alias("of")).select("label", "of.*").select("label", *FEATURES)


def forest(findings: DataFrame, trees: int = TREES, depth: int = DEPTH):
    """The trained model, or None unless both kinds of findings are there."""
    findings = stage(findings.coalesce(1), "training")  # a bounded table, in one part so that training repeats
    if findings.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(findings)
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="onethird").fit(rows)


def vote(node, of: Column) -> Column:
    """A tree of the forest as nested conditions over the feature columns."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    left = of[FEATURES[split.featureIndex()]] <= F.lit(float(split.threshold()))
    return F.when(left, vote(node.leftChild(), of)).otherwise(vote(node.rightChild(), of))


def probability(model, of: Column) -> Column:
    """The share of trees that call a finding a secret."""
    if model is None:
        return F.coalesce(plain_label(of), F.lit(0.0))
    votes = [vote(tree._java_obj.rootNode(), of) for tree in model.trees]
    total = votes[0]
    for v in votes[1:]:
        total = total + v
    return total / len(votes)


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, out: str = "scan") -> DataFrame:
    """The input rows with one more column `out`: n_candidates, the secrets as (start, length, score) in code points, and
    the redacted text. `findings` is a table of labelled findings (label and FEATURES)."""
    known = dictionary(docs)
    learned = labelled_findings(docs, known).union(examples(docs.sparkSession, known)) if findings is None else findings.select("label", *FEATURES)
    model = forest(learned)
    name = fresh(docs, "_scan")
    rows = scanned(docs, known, name)
    cell = F.col(name)
    scored = F.transform(cell["found"], lambda c: F.struct(c["text"].alias("text"), probability(model, c["of"]).alias("score")))
    rows = rows.withColumn(name, F.struct(cell["between"].alias("between"), scored.alias("found")))
    # The masked texts and the texts between take turns; one more string between than candidates.
    shown = lambda c: F.coalesce(F.when(c["score"] > threshold, F.lit(MASK)).otherwise(c["text"]), F.lit(""))
    masked = F.zip_with(cell["between"], cell["found"], lambda b, c: F.concat(b, shown(c)))
    secret = "struct<start:int,length:int,score:double>"
    place = F.zip_with(cell["between"], cell["found"], lambda b, c: F.struct(F.length(b).alias("gap"), F.coalesce(F.length(c["text"]), F.lit(0)).alias("length"), F.coalesce(c["score"], F.lit(0.0)).alias("score")))

    def step(state: Column, c: Column) -> Column:
        start = state["at"] + c["gap"]
        more = F.concat(state["secrets"], F.array(F.struct(start.alias("start"), c["length"].alias("length"), c["score"].alias("score")).cast(secret)))
        return F.struct((start + c["length"]).alias("at"), F.when(c["score"] > threshold, more).otherwise(state["secrets"]).alias("secrets"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{secret}>").alias("secrets"))
    result = F.struct(F.size(cell["found"]).cast("long").alias("n_candidates"), F.aggregate(place, empty, step)["secrets"].alias("secrets"),
                      F.when(F.col("text").isNotNull(), F.array_join(masked, "")).alias("redacted"))
    return rows.withColumn(out, result).drop(name)


def redact(docs: DataFrame, **options) -> DataFrame:
    """The input rows with every secret masked; n_chars follows the text where the column is there."""
    out = fresh(docs, "_found")
    rows = scan(docs, out=out, **options)
    changed = F.size(f"{out}.secrets") > 0
    new = {"text": F.when(changed, F.col(f"{out}.redacted")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(f"{out}.redacted").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.withColumns(new).select(docs.columns)
