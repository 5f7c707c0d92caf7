"""Secrets in texts: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.llm.common import cannot_be_in, may_be_in, stored

#: What a finding is replaced with.
MASK = "[SECRET]"
#: Built-in labelled findings of each kind, trees of the forest and their depth.
EXAMPLES, TREES, DEPTH = 60, 24, 6

# A run of 16 or more characters with a digit, six or more after the name of a secret, or the password of
# a URL (from four on: masking a shorter one would mask parts of common words). The name may go on up to
# the next name in it; a value ends before ;key=, &key= or ,key=. _EACH matches without taking text, so
# that values inside others are found too, and only in the last word.
_RUN = r"(?=[A-Za-z_+/.\-]*[0-9])[A-Za-z0-9_+/.\-]{16,}={0,2}"
_NAME = r"passw(?:or)?d|passphrase|pwd|secret|token|api[_\-]?key|credential|private[_\-]?key"
_NAMED = rf"(?i)(?:{_NAME})(?:(?!{_NAME})[a-z0-9_\-])*+[\"']?\s*[:=]+\s*[\"']?((?:(?![;&,][a-z0-9_.\-]+=)[^\s\"']){{6,}}+)"
_EACH = rf"(?i)(?={_NAMED[4:]}\S*+$)"
_LOGIN = r"://[^\s/:@\"']*:([^\s/\"']{4,})@"
_PREFIX = r"^(?:AKIA|ASIA|gh[pousr]_|xox[abp]-|sk_live_|sk-|AIza|eyJ|glpat-)"
_PLACEHOLDER = r"(?i)\b(?:example|sample|dummy|test|placeholder|todo|changeme|your)\b|x{6,}|(?:1234567|abcdefg)"

FEATURES = ["n", "digits", "uppers", "lowers", "others", "distinct", "transitions", "dictionary", "path", "mail", "named", "assigned", "prefix", "placeholder", "quoted", "login", "test_source"]


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str | None = "source") -> DataFrame:
    """(id, source, value, before, after): each candidate value with what stands around it, two words before and one behind."""
    source = F.col(source_column).cast("string") if source_column else F.lit(None).cast("string")
    words = docs.where(F.col(text_column).rlike(_RUN) | F.col(text_column).rlike(_NAMED) | F.col(text_column).rlike(_LOGIN)).select(
        F.col(id_column).alias("id"), source.alias("source"), F.split(text_column, r"\s+").alias("words")
    )
    # Neighbours come from shifted copies: a look-up by number inside a function would have the text
    # split again for every word, since Spark merges projections.
    shifted = words.select(
        "id",
        "source",
        F.col("words").alias("w"),
        F.concat(F.array(F.lit("")), "words").alias("one"),
        F.concat(F.array(F.lit(""), F.lit("")), "words").alias("two"),
        F.slice("words", F.lit(2), F.size("words")).alias("after"),
    )
    around = F.transform(
        F.arrays_zip("w", "one", "two", "after"),
        lambda x: F.struct(x["w"].alias("w"), F.trim(F.concat_ws(" ", x["two"], x["one"])).alias("before"), F.coalesce(x["after"], F.lit("")).alias("after")),
    )
    hit = F.filter(around, lambda x: x["w"].rlike(_RUN) | F.concat_ws(" ", x["before"], x["w"]).rlike(_EACH) | x["w"].rlike(_LOGIN))
    found = shifted.select("id", "source", F.explode(hit).alias("x")).select("id", "source", "x.*")
    bare = lambda v: F.regexp_replace(v, r"[.,;:!?)\]}|&$%*]+$", "")
    named = F.filter(F.transform(F.regexp_extract_all(F.concat_ws(" ", "before", "w"), F.lit(_EACH), 1), bare), lambda v: F.length(v) >= 6)
    values = F.array_distinct(F.concat(F.regexp_extract_all("w", F.lit(f"({_RUN})")), named, F.regexp_extract_all("w", F.lit(_LOGIN), 1)))
    each = found.select("id", "source", "w", "before", "after", F.explode(values).alias("value"))
    at = F.instr("w", F.col("value"))
    return each.select(
        "id",
        "source",
        "value",
        F.concat_ws(" ", "before", F.substring("w", F.lit(1), at - 1)).alias("before"),
        F.concat_ws(" ", F.expr("substring(w, instr(w, value) + length(value))"), "after").alias("after"),
    )


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Words of three or more letters a-z in a public vocabulary file (base64 text and rank per line)."""
    lines = spark.read.text(f"file://{path}" if path.startswith("/") else path)
    word = F.trim(F.lower(F.unbase64(F.split("value", " ")[0]).cast("string")))
    return lines.select(word.alias("word")).where(F.col("word").rlike("^[a-z]{3,}$")).distinct()


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns FEATURES, all of them numbers."""
    v = F.col("value")
    pieces = found.select("value").distinct().select("value", F.explode(F.regexp_extract_all(F.lower(v), F.lit("([a-z]{3,})"))).alias("word"))
    known = pieces.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("known"))
    n = F.length(v)
    share = lambda kind: (n - F.length(F.regexp_replace(v, kind, ""))) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.join(known, "value", "left").select(
        *found.columns,
        F.least(n, F.lit(200)).cast("double").alias("n"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"),
        share("[a-z]").alias("lowers"),
        share("[^0-9A-Za-z]").alias("others"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("distinct"),
        ((F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / n).alias("transitions"),
        F.coalesce(F.col("known") / n, F.lit(0.0)).alias("dictionary"),
        ((n - F.length(F.regexp_replace(v, r"[/.]", ""))) / n).alias("path"),
        flag(F.col("before").rlike(r"(@|://)$") | F.col("after").rlike("^@")).alias("mail"),
        flag(F.col("before").rlike(f"(?i){_NAME}")).alias("named"),
        flag(F.col("before").rlike(r"[:=][*&%$!|]*\s*[\"']?$")).alias("assigned"),
        flag(v.rlike(_PREFIX)).alias("prefix"),
        flag(v.rlike(_PLACEHOLDER) | F.col("before").rlike(_PLACEHOLDER)).alias("placeholder"),
        flag(F.col("after").rlike("^[\"']")).alias("quoted"),
        flag(F.col("before").rlike(r"://[^\s/:@\"']*:$") & F.col("after").rlike("^@")).alias("login"),
        flag(F.col("source").rlike(r"(?i)test|example|fixture|spec|vendor|\.lock")).alias("test_source"),
    )


def labelled_findings(spark: SparkSession, each: int = EXAMPLES) -> DataFrame:
    """Built-in labelled findings (source, before, value, after, label), of public key formats and of what is taken for them.

    Columns of the list: label, text before, value and text behind, as SQL on the number n, its digest
    h (hexadecimal) and that digest in base64, b.
    """
    kinds = [
        (1, "'token = \"'", "substr(h, 1, 40)", "'\" and'"),
        (1, "'and TOKEN = \"'", "upper(substr(h, 1, 40))", "'\"!!'"),
        (1, "'x api_key: '", "substr(h, 1, 32)", "''"),
        (1, "'the password='", "substr(h, 1, 18)", "' of'"),
        (1, "'password='", "concat(substr(h, 1, 5), '!', substr(b, 1, 6))", "' in'"),
        (1, "'secret: \"'", "substr(b, 1, 40)", "'\",'"),
        (1, "'it the '", "concat('AKIA', upper(substr(translate(b, '+/=', ''), 1, 16)))", "' and'"),
        (1, "'key '", "concat('ghp_', substr(translate(b, '+/=', ''), 1, 36))", "''"),
        (1, "'is '", "concat('sk_live_', substr(translate(b, '+/=', ''), 1, 24))", "'.'"),
        (1, "'Bearer '", "concat('eyJ', translate(b, '+/=', '-_'), '.', substr(b, 3, 20))", "''"),
        (1, "'aws_secret_access_key = '", "substr(b, 1, 40)", "''"),
        (1, "'client_secret=\"'", "concat(substr(b, 1, 24), '==')", "'\"'"),
        (1, "'SECRET_KEY='", "concat(substr(b, 1, 9), '!', substr(h, 1, 6))", "''"),
        (1, "'DB_PASSWORD_PROD='", "concat(substr(b, 1, 5), '!', substr(h, 1, 3))", "' of'"),
        (1, "'{\"user\":\"a\",\"token\":\"'", "concat(substr(h, 1, 3), '!', substr(b, 1, 5))", "'\"}'"),
        (1, "'password=some!one token='", "concat(substr(b, 1, 3), '!', substr(b, 5, 5))", "' and'"),
        (1, "'the token='", "translate(concat(substr(h, 1, 3), '!', substr(h, 4, 5)), '0123456789', 'ghijklmnop')", "' of'"),
        (1, "'{\"password\":\"x!\",\"secret\":\"'", "translate(concat(substr(h, 1, 4), '!', substr(h, 5, 4)), '0123456789', 'ghijklmnop')", "'\"}'"),
        (1, "'postgres://app:'", "concat(substr(h, 1, 3), '!', substr(b, 1, 3))", "'@db.host:5432/main'"),
        (1, "'see amqp://user:'", "concat(substr(b, 1, 4), substr(h, 1, 3))", "'@queue/'"),
        (0, "'https://user:'", "element_at(array('password', 'your-password', 'example', 'secret'), CAST(n % 4 + 1 AS INT))", "'@host/'"),
        (0, "'the secretary: '", "element_at(array('something', 'meeting', 'chairman', 'between', 'another'), CAST(n % 5 + 1 AS INT))", "' of'"),
        (0, "'token_count: '", "CAST(100000 + n * 37 AS STRING)", "','"),
        (0, "'the of '", "substr(translate(h, 'abcdef', '012345'), 1, 16)", "' and'"),
        (0, "'card '", "substr(translate(h, 'abcdef', '678901'), 1, 16)", "','"),
        (0, "'tel '", "concat('+', substr(translate(h, 'abcdef', '678901'), 1, 15))", "' in'"),
        (0, "concat('to user', n % 90, '@')", "concat('mail', n % 100, '.example.com')", "' is'"),
        (0, "'see https://'", "concat('www.site', n % 100, '.org/pages/item-', n)", "' for'"),
        (0, "'at '", "concat('2024-0', n % 9 + 1, '-12T10:', 10 + n % 50, ':00')", "''"),
        (0, "'import '", "concat('org.package', n % 10, '.module.ClassName', n % 7)", "''"),
        (0, "'open '", "concat('/usr/lib/share', n % 10, '/library-', n % 9, '.so')", "''"),
        (0, "'commit '", "substr(h, 1, 40)", "' fixes'"),
        (0, "'sha256 '", "h", "''"),
        (0, "'id '", "concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))", "''"),
        (0, "'token = \"'", "concat('your-token-here-', n % 10)", "'\"'"),
        (0, "'password: '", "concat('changeme', n % 10)", "''"),
        (0, "'the token: '", "concat('example', n % 10, 'example', n % 10, 'key')", "''"),
        (0, "'a word '", "concat('thinneronreshble', n % 10, '-andother')", "' of'"),
        (0, "'version '", "concat('release-candidate-', n % 20, '.', n % 7, '.0')", "''"),
        (0, "'table '", "concat('identifier_with_number_', n % 30)", "''"),
        (0, "'page '", "concat('page=', n, '..', n, '..', n, '..', n)", "''"),
    ]
    sources = "element_at(array('src/app', 'web/page', NULL, 'tests/fixtures', 'vendor/module.lock'), CAST(n % 5 + 1 AS INT))"
    rows = " UNION ALL ".join(f"SELECT {sources} AS source, {b} AS before, {v} AS value, {a} AS after, {label}D AS label, {k} AS kind, n FROM made" for k, (label, b, v, a) in enumerate(kinds))
    made = f"SELECT id AS n, sha2(CAST(id AS STRING), 256) AS h, base64(unhex(sha2(concat('b', id), 256))) AS b FROM range({each})"
    return spark.sql(f"WITH made AS ({made}) {rows}")


def train(labelled: DataFrame, words: DataFrame) -> PipelineModel:
    """A random forest over FEATURES from labelled findings (source, before, value, after, label: 1 a secret, 0 none).

    The labelled findings are small by nature; they are brought into one order first, so that the
    forest depends on nothing but them.
    """
    ready = features(labelled.select("source", "before", "value", "after", "label"), words).coalesce(1).sort(*FEATURES, "value", "before", "label")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="sqrt", seed=6)
    return Pipeline(stages=[assembler, forest]).fit(ready)


def find_secrets(
    docs: DataFrame, words: DataFrame, model: PipelineModel, id_column: str = "doc_id", text_column: str = "text", source_column: str | None = "source", least: float = 0.5
) -> DataFrame:
    """(id, secret, probability) of every distinct finding of every document.

    Candidates come from the whole text. A candidate that occurs several times in a document counts
    with its most suspicious surroundings. Null and empty texts have none; repeated rows are one
    document. Other columns are ignored; ``words`` is a dictionary as ``dictionary`` gives it.
    """
    found = stored(candidates(docs, id_column, text_column, source_column), "secret-candidates")  # read twice below
    judged = model.transform(features(found, words))
    scored = judged.select("id", F.col("value").alias("secret"), vector_to_array("probability")[1].alias("probability")).where(F.col("probability") >= least)
    return scored.groupBy("id", "secret").agg(F.max("probability").alias("probability")).withColumnRenamed("id", id_column)


def mask_secrets(docs: DataFrame, findings: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = None) -> DataFrame:
    """``docs`` with every occurrence of a document's findings replaced by MASK, longest findings first;
    ``length_column``, if named, gets the length of each text that changes.

    All columns and rows stay, documents without findings as they are; rows of a null id too, of
    which findings cannot be told apart by row but apply to all rows without id. Only documents that
    may have findings are joined with them, so that the other texts are not shuffled.
    """
    by_length = F.transform(F.array_sort(F.collect_set(F.struct((-F.length("secret")).alias("n"), F.col("secret").alias("s")))), lambda x: x["s"])
    each = findings.groupBy(F.col(id_column).alias("__id")).agg(by_length.alias("__secrets"))
    each = stored(each, "secret-lists")
    joined = may_be_in(docs, id_column, each.select("__id")).join(each, F.col(id_column).eqNullSafe(F.col("__id")), "left")
    masked: Column = F.aggregate("__secrets", F.col(text_column), lambda t, s: F.replace(t, s, F.lit(MASK)))
    kinds = dict(docs.dtypes)
    changed = {text_column: masked}
    if length_column:
        changed[length_column] = F.length(masked).cast(kinds[length_column])
    found = joined.select(*[F.when(F.col("__secrets").isNull(), F.col(c)).otherwise(changed[c]).alias(c) if c in changed else F.col(c) for c in docs.columns])
    return found.union(cannot_be_in(docs, id_column, each.select("__id")))
