"""Secret scanning: a random forest over candidates, in DataFrame functions only.

Candidates are long runs of key-like characters (16, or 20 without a digit),
quoted values of 8 after an assignment mark, any value of 6 after a key word and
an assignment mark, in quotes also with spaces, and passwords in URLs. A random forest trained on labelled
findings removes the false positives. It sees the candidate's length, its
character transitions and classes, the share of it that dictionary words cover,
marks of a path, and the neighbouring words: key words such as token or
password, and words of harmless values such as commit or checksum.

The forest is fitted by Spark ML on the findings only, whose number is a
parameter, and turned into one SQL expression. It then runs inside the scan,
in the candidates' array of each row: no shuffle, no join, no Python.

Labelled findings are rows (text, label): a text with one candidate and whether
that is a secret. ``labelled_findings`` makes a balanced set from templates and
hashed values; any other set of this form can be given.

Null and empty texts have no candidates. Rows of one id are scanned each for
itself. Extra columns are kept by ``redact``. An empty table gives no rows.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .names import free
from .spans import chunks_sql, cut_sql, located_sql, quoted

# Fixed word lists of the features.
KEY_WORDS = r"(?i)(token|secret|passw|passphrase|pwd|api[_ -]?key|apikey|access[_ -]?key|private[_ -]?key|auth|bearer|credential|client[_ -]?key|signature)"
HARMLESS_WORDS = (
    r"(?i)(commit|revision|checksum|digest|sha-?1|sha-?256|sha-?512|md5|uuid|guid|integrity|etag|hash of|build|version|order|invoice|"
    r"number|example|sample|placeholder|changeme|dummy|isbn|serial|ticket|path|file|url|http)"
)
# A key word (an author is none) and an assignment mark, as they stand before a value.
_KEYED = KEY_WORDS[4:].replace("|auth|", "|auth(?!or[^i])|") + r"""[A-Za-z0-9_-]{0,20}["']?\s{0,3}(?:=>|:=|[=:])\s{0,3}"""
_AFTER = rf"(?<=[=:>]\s{{0,3}})(?<=(?i:{_KEYED}))"
CANDIDATE = (
    # Any value after a key word and an assignment mark, to the closing quote or to white space, less closing marks.
    rf"""(?<=["'])(?<=[=:>]\s{{0,3}}["'])(?<=(?i:{_KEYED})["'])(?:(?<=")[^"\r\n]{{6,}}+(?=")|(?<=')[^'\r\n]{{6,}}+(?='))"""
    rf"""|(?<=[=:>\s]){_AFTER}(?!(?i:bearer|basic|token)\s)(?=[^\s"'\[(])[^\s"']{{5,}}[^\s"',;.)\]}}]"""
    # A password in a URL's user part.
    r"""|(?<=:)(?<=://[^\s/:@"']{0,64}:)[^\s/@"']{3,}+(?=@)"""
    # Long runs, and long ones of letters only.
    r"|(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+={0,2}"
    r"|(?<![A-Za-z0-9_+/-])(?=[_+/-]*+[A-Za-z])[A-Za-z_+/-]{20,}+={0,2}"
    # Quoted values after any assignment mark.
    r"""|(?<=["'])(?<=[=:>]\s{0,3}["'])[^\s"']{8,}+"""
)
# Texts without this hold no candidate.
HINT = r"""[0-9=:>]|[A-Za-z_+/-]{20}"""
DICTIONARY = (
    "the and for you your with this that from have not are was but all can out use key token secret password user name test example "
    "sample value data file path home local lib bin src main config index default admin server client class function return string "
    "number version release build package module service account public private access change place holder insert here replace "
    "enter dummy fake demo image page time date text type list item node http https www com org net html json yaml log tmp usr etc var"
).split()
FEATURES = (
    "length", "transitions", "digits", "uppers", "hex", "distinct", "words", "slashes", "inpath", "keyword", "harmless", "assigned",
    "quoted", "keyed", "userinfo", "spaces", "lowers", "marks",
)


def _features_sql(v: str, before: str, after: str) -> dict[str, str]:
    cover = "(?i)(" + "|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=lambda w: (-len(w), w))) + ")"
    n = f"length({v})"
    return {
        "length": f"{n}",
        "transitions": f"(regexp_count({v}, '[a-z](?=[^a-z])') + regexp_count({v}, '[A-Z](?=[^A-Z])') + regexp_count({v}, '[0-9](?=[^0-9])')) / {n}",
        "digits": f"regexp_count({v}, '[0-9]') / {n}",
        "uppers": f"regexp_count({v}, '[A-Z]') / {n}",
        "hex": f"regexp_count({v}, '[0-9a-fA-F]') / {n}",
        "distinct": f"size(array_distinct(split({v}, ''))) / least({n}, 64)",
        "words": f"1 - length(regexp_replace({v}, {quoted(cover)}, '')) / {n}",
        "slashes": f"regexp_count({v}, '[/_-]') / {n}",
        "inpath": f"IF({before} RLIKE {quoted('[/.@:]$')} OR {after} RLIKE {quoted('^([/@:]|[.][a-z])')}, 1, 0)",
        "keyword": f"IF({before} RLIKE {quoted(KEY_WORDS)}, 1, 0)",
        "harmless": f"IF(concat({before}, ' ', {after}) RLIKE {quoted(HARMLESS_WORDS)}, 1, 0)",
        "assigned": f"IF({before} RLIKE {quoted(chr(91) + '=:>' + chr(93) + '[ ]?[' + chr(34) + chr(39) + ']?$')}, 1, 0)",
        "quoted": f"IF({before} RLIKE {quoted('[' + chr(34) + chr(39) + ']$')}, 1, 0)",
        "keyed": f"IF({before} RLIKE {quoted('(?i)' + _KEYED + '[' + chr(34) + chr(39) + ']?$')}, 1, 0)",
        "userinfo": f"IF({before} RLIKE {quoted('://[^/:@ ]*:$')} AND {after} LIKE '@%', 1, 0)",
        "spaces": f"regexp_count({v}, ' ')",
        "lowers": f"regexp_count({v}, '[a-z]') / {n}",
        "marks": f"regexp_count({v}, '[^A-Za-z0-9]') / {n}",
    }


def candidates_sql(text: str) -> str:
    """SQL for the candidates in ``text`` as structs (s, e, v, g, one field per feature), g what
    stands between a candidate and the one before it."""
    fields = ", ".join(f"CAST({sql} AS double) AS {name}" for name, sql in _features_sql("x.v", "x.b", "x.a").items())
    # Both lists are bound once: the text's chunks, and the candidates with what stands around them.
    around = f"transform(found, c -> struct(c.s AS s, c.e AS e, c.m AS v, c.g AS g, right(c.g, 40) AS b, {cut_sql('chunks', 'c.e', '24')} AS a))"
    return f"""
    element_at(transform(array({located_sql(text, quoted(CANDIDATE))}), found -> IF(size(found) = 0, {_NO_CANDIDATES}, element_at(
      transform(array({chunks_sql(text)}), chunks -> transform({around}, x -> struct(x.s AS s, x.e AS e, x.v AS v, x.g AS g, {fields}))), 1))), 1)"""


_NO_CANDIDATES = "CAST(array() AS array<struct<s:int,e:int,v:string,g:string," + ",".join(f"{f}:double" for f in FEATURES) + ">>)"


def with_candidates(docs: DataFrame, text_col: str, out_col: str) -> DataFrame:
    text = f"coalesce(CAST(`{text_col}` AS string), '')"
    return docs.withColumn(out_col, F.expr(f"CASE WHEN {text} RLIKE {quoted(HINT)} THEN {candidates_sql(text)} ELSE {_NO_CANDIDATES} END"))


# Labelled findings: what stands before and after a value, the value's kind, and whether it is a secret.
TEMPLATES = (
    ('token = "', '"', "hex40", 1), ("api_key: '", "'", "mixed32", 1), ("password = \"", '"', "password", 1),
    ("Authorization: Bearer ", "", "base64", 1), ("aws_secret_access_key=", "\n", "base64", 1), ("secret ", ".", "hex40", 1),
    ('"client_secret": "', '",', "mixed32", 1), ("export AUTH_TOKEN=", "\n", "prefixed", 1), ("access key ", " was", "upper20", 1),
    ("token = \"", "\"***", "hex40", 1), ("passwd: ", " ", "mixed32", 1), ("the token ", " and", "hex32", 1),
    ("TOKEN = \"", "\"!!", "upperhex", 1), ("key='", "'", "prefixed", 1), ("private_key = ", "", "hex64", 1),
    ("commit ", " merged", "hex40", 0), ("sha256: ", " ok", "hex64", 0), ("md5 checksum ", "", "hex32", 0),
    ("id = ", ",", "uuid", 0), ("see /usr/lib/", ".so", "words", 0), ("file ", "_test.py", "words", 0),
    ('token = "', '"', "placeholder", 0), ("apiKey = 'your_", "'", "placeholder", 0), ("order number ", " shipped", "digits", 0),
    ("card ", " of", "digits", 0), ("revision ", ".", "hex40", 0), ("integrity sha512-", "==", "base64", 0),
    ("https://example.com/", "/page", "words", 0), ("build ", " released", "version", 0), ('title = "', '"', "words", 0),
    ("etag: ", "", "hex32", 0), ("version \"", "\"", "version", 0), ("call ", " now", "digits", 0), ("uuid ", "", "uuid", 0),
    ("password=", "\n", "short", 1), ("DB_PASSWORD=", "", "marked", 1), ("passwd: ", " ", "short", 1), ("pwd = ", "", "marked", 1),
    ("postgres://app:", "@db.host/x", "marked", 1), ("https://user:", "@example.com/", "short", 1), ('token => "', '"', "short", 1),
    ('token = "', '"', "phrase", 1), ("passphrase: '", "'", "phrase", 1), ("secret: ", "", "letters", 1), ("access key ", " was", "capitals", 1),
    ('api_key = "', '"', "letters", 1), ("key id ", ".", "capitals", 1), ("client_secret=", "", "letters", 1),
    ("author: ", " wrote", "plain", 0), ("password: ", " and", "plain", 0), ("the token: ", " of", "plain", 0), ("auth = ", "()", "names", 0),
    ("see /", "/", "folders", 0), ("call ", "()", "names", 0), ("https://example.com/", "", "folders", 0), ("the word ", ".", "longword", 0),
    ("line ", "", "repeat", 0), ("password=", "", "placeholder", 0), ('password: "', '"', "sentence", 0), ("token = ", "", "names", 0),
    ("mixed ", "", "folders", 0), ('secret: "', '"', "sentence", 0), ("the ", " of", "longword", 0),
)
_HEX = "sha2(concat('a', id), 512)"
# Syllables joined to words that are in no list.
_SYLLABLES = "array('cor', 'rect', 'hor', 'bat', 'ter', 'sta', 'ple', 'mon', 'del', 'ver', 'lin', 'gra', 'nos', 'pet', 'ul', 'fam')"


def _word(k: int) -> str:
    return "concat(" + ", ".join(f"element_at({_SYLLABLES}, CAST(pmod(xxhash64(id, {10 * k + j}), 16) AS int) + 1)" for j in (1, 2)) + ")"


_VALUES = {
    "hex40": f"substr({_HEX}, 1, 40)",
    "hex32": f"substr({_HEX}, 1, 32)",
    "hex64": f"substr({_HEX}, 1, 64)",
    "upperhex": f"upper(substr({_HEX}, 1, 40))",
    "mixed32": f"substr(translate(base64(unhex({_HEX})), '+/=\n\r', 'xyz'), 1, 24 + CAST(id % 17 AS int))",
    "base64": f"substr(translate(base64(unhex({_HEX})), '\n\r', ''), 1, 40)",
    "upper20": f"concat('AK', upper(substr(translate(base64(unhex({_HEX})), '+/=\n\r', 'xyz'), 1, 18)))",
    "prefixed": f"concat(element_at(array('ghp_', 'sk-live-', 'xoxb-', 'glpat-'), CAST(id % 4 AS int) + 1), substr(translate(base64(unhex({_HEX})), '+/=\n\r', 'xyz'), 1, 32))",
    "password": f"concat(substr(translate(base64(unhex({_HEX})), '=\n\r', 'z'), 1, 10), element_at(array('!', '#', '\\$9', '?x'), CAST(id % 4 AS int) + 1))",
    "short": f"concat(element_at(array('hunter', 'Tiger', 'blue', 'Zx', 'qw', 'mint', 's3c'), CAST(pmod(xxhash64(id, 8), 7) AS int) + 1), "
    f"substr({_HEX}, 1, 2 + CAST(pmod(xxhash64(id, 9), 5) AS int)), element_at(array('-Prod', '7x', '!', 'Q9'), CAST(pmod(xxhash64(id, 5), 4) AS int) + 1))",
    "marked": f"concat(substr(translate(base64(unhex({_HEX})), '+/=\n\r', 'xyz'), 1, 3 + CAST(pmod(xxhash64(id, 9), 7) AS int)), element_at(array('!', '&', '#', '*'), "
    f"CAST(pmod(xxhash64(id, 6), 4) AS int) + 1), substr({_HEX}, 9, 1 + CAST(pmod(xxhash64(id, 9), 3) AS int)), 'd7')",
    "phrase": f"concat_ws(' ', {_word(1)}, {_word(2)}, {_word(3)})",
    "letters": f"substr(translate(base64(unhex({_HEX})), '0123456789+/=\n\r', 'qWzKpXvHjRab'), 1, 24 + CAST(id % 17 AS int))",
    "capitals": f"concat('AKIA', upper(translate(substr({_HEX}, 1, 16), '0123456789', 'QWZKPXVHJR')))",
    "plain": f"concat({_word(1)}, {_word(2)}, IF(pmod(xxhash64(id, 9), 2) = 0, 'ing', ''))",
    "longword": f"concat({_word(1)}, {_word(2)}, {_word(3)}, {_word(4)}, 'ification')",
    "names": "concat(element_at(dictionary, CAST(pmod(xxhash64(id, 1), size(dictionary)) AS int) + 1), '_', element_at(dictionary, CAST(pmod(xxhash64(id, 2), "
    "size(dictionary)) AS int) + 1), initcap(element_at(dictionary, CAST(pmod(xxhash64(id, 3), size(dictionary)) AS int) + 1)), 'ConfigurationValue')",
    "folders": f"concat_ws(element_at(array('/', '-', '_'), CAST(pmod(xxhash64(id, 9), 3) AS int) + 1), {_word(1)}, {_word(2)}, {_word(3)}, {_word(4)}, 'directory')",
    "repeat": "repeat(element_at(array('x', '-a', 'ab', '_x', 'A'), CAST(pmod(xxhash64(id, 9), 5) AS int) + 1), 24 + CAST(pmod(xxhash64(id, 9), 50) AS int))",
    "sentence": "concat('enter your ', element_at(dictionary, CAST(pmod(xxhash64(id, 1), size(dictionary)) AS int) + 1), ' here')",
    "uuid": f"regexp_replace(substr({_HEX}, 1, 32), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\$1-\\$2-\\$3-\\$4-\\$5')",
    "digits": f"substr(translate({_HEX}, 'abcdef', '123456'), 1, 12 + CAST(id % 8 AS int))",
    "version": "concat('release-', id % 40, '-', id % 7, '-build-', 1000 + id)",
    "words": "concat(element_at(dictionary, CAST(pmod(xxhash64(id, 1), size(dictionary)) AS int) + 1), '_', "
    "element_at(dictionary, CAST(pmod(xxhash64(id, 2), size(dictionary)) AS int) + 1), '_', "
    "element_at(dictionary, CAST(pmod(xxhash64(id, 3), size(dictionary)) AS int) + 1), id % 100, '_', "
    "element_at(dictionary, CAST(pmod(xxhash64(id, 4), size(dictionary)) AS int) + 1))",
    "placeholder": "concat(element_at(array('example-token-', 'your_secret_key_', 'changeme-password-', 'insert-token-here-', 'test_api_key_', 'xxxxxxxxxxxxxxxx'), "
    "CAST(id % 6 AS int) + 1), 1 + id % 9)",
}


def labelled_findings(spark: SparkSession, rows: int = 3400) -> DataFrame:
    """``rows`` labelled findings (text, label) from the templates, in turn."""
    parts = spark.range(rows).withColumn("t", (F.col("id") % len(TEMPLATES)).cast("int"))
    parts = parts.withColumn("dictionary", F.array(*[F.lit(w) for w in DICTIONARY]))
    kinds = {k: F.expr(sql) for k, sql in _VALUES.items()}

    def pick(k):
        return F.element_at(F.array(*[F.lit(t[k]) for t in TEMPLATES]), F.col("t") + 1)

    value = F.coalesce(*[F.when(pick(2) == k, sql) for k, sql in kinds.items()])
    around = F.element_at(F.array(*[F.lit(w) for w in ("the", "with it", "In this", "of and", "are", "thening", "ist die", "de la")]), (F.col("id") % 8).cast("int") + 1)
    return parts.select(F.concat(around, F.lit(" "), pick(0), value, pick(1), F.lit(" "), around).alias("text"), pick(3).cast("int").alias("label"))


def _tree_sql(node, struct: str) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        counts = list(node.impurityStats().stats())
        return repr(float(counts[1] / max(1e-9, counts[0] + counts[1])))
    split = node.split()
    left, right = _tree_sql(node.leftChild(), struct), _tree_sql(node.rightChild(), struct)
    return f"IF({struct}.{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D, {left}D, {right}D)".replace("DD", "D").replace(")D", ")")


def fit_forest(findings: DataFrame, trees: int = 20, depth: int = 6, seed: int = 17) -> str:
    """The forest over a candidate struct ``c``, as SQL for the probability of a secret."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = with_candidates(findings, "text", "found").select("label", F.explode("found").alias("c")).select("label", "c.*")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows.withColumn("y", F.col("label").cast("double")))
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed).fit(vectors.select("x", "y"))
    votes = [_tree_sql(tree._java_obj.rootNode() if hasattr(tree, "_java_obj") else tree._call_java("rootNode"), "c") for tree in forest.trees]
    return "(" + " + ".join(votes) + f") / {len(votes)}D"


def with_findings(docs: DataFrame, out_col: str, text_col: str = "text", findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with the array ``out_col`` of candidates (s, e, v, g, score, secret), g what stands
    between a candidate and the one before it."""
    forest = fit_forest(labelled_findings(docs.sparkSession) if findings is None else findings)
    found = with_candidates(docs, text_col, out_col)
    scored = f"transform(`{out_col}`, c -> struct(c.s AS s, c.e AS e, c.v AS v, c.g AS g, {forest} AS score))"
    return found.withColumn(out_col, F.expr(scored)).withColumn(
        out_col, F.expr(f"transform(`{out_col}`, c -> struct(c.s AS s, c.e AS e, c.v AS v, c.g AS g, c.score AS score, c.score >= {threshold}D AS secret))")
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_candidates, n_secrets and secrets
    (start:end pairs, comma-joined)."""
    ided = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = with_findings(ided, "found", "text", **options)
    return found.select(
        "doc_id", F.expr("CAST(size(found) AS long)").alias("n_candidates"),
        F.expr("CAST(size(filter(found, c -> c.secret)) AS long)").alias("n_secrets"),
        F.expr("array_join(transform(filter(found, c -> c.secret), c -> concat(c.s, ':', c.e)), ',')").alias("secrets"),
    )


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``, and ``chars_col``,
    if there is one, counted anew for the texts that changed."""
    (name,) = free(docs.columns, "secrets")
    found = with_findings(docs, name, text_col, **options)
    text, changed = f"CAST(`{text_col}` AS string)", f"exists(`{name}`, c -> c.secret)"
    # The text anew from its gaps, its candidates and its end.
    parts = f"concat(transform(`{name}`, c -> concat(c.g, IF(c.secret, {quoted(mark)}, c.v))), array(substr({text}, element_at(`{name}`, -1).e + 1)))"
    cleaned = found.withColumn(name, F.expr(f"IF({changed}, array_join({parts}, ''), NULL)"))
    cleaned = cleaned.withColumn(text_col, F.expr(f"coalesce(`{name}`, `{text_col}`)"))
    if chars_col in docs.columns:
        cleaned = cleaned.withColumn(
            chars_col, F.expr(f"IF(`{name}` IS NOT NULL, CAST(length(`{text_col}`) AS {docs.schema[chars_col].dataType.simpleString()}), `{chars_col}`)")
        )
    return cleaned.select(*docs.columns)
