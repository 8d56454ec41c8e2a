"""The registered queries of the training-data operators and the SQL that checks them.

Each query applies its operator to its whole table. SQL is given where it can state the whole result; the other queries are
tested against brute force, exact round trips or held-out labels in `tests/llm`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import chunks, conversations, decontaminate, languages, licenses, mixing, ngram_lm, quality_neighbours, quality_rules, simhash, spelling, token_files, url_rules
from broadsheet.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, radius=3)


@query("op2_benchmark_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of labelled documents in the mix: 2 for good ones, a half for bad ones; the others weigh 1."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("weight"))


MIX_SQL = r"""
WITH known AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END)::DOUBLE AS weight FROM labels GROUP BY doc_id),
docs AS (
  SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5(d.doc_id::VARCHAR), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE) / coalesce(weight, 1.0) AS k
  FROM documents d LEFT JOIN known USING (doc_id)),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source::BLOB) - 1 AS place, source_size * 2.0::DOUBLE AS most,
         ([3.0, 1.0, 2.0])[(row_number() OVER (ORDER BY source IS NULL, source::BLOB) - 1) % 3 + 1]::DOUBLE AS weight FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
rising AS (SELECT min_by(level, (most / weight, place)) AS level FROM levels WHERE level <= most / weight),
aims AS (SELECT source, source_size, CASE WHEN rising.level IS NULL THEN most ELSE least(most, rising.level * weight) END AS target FROM levels, rising),
ordered AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source, source_size, target,
       (CASE WHEN size > 0 THEN epochs + (seen + size / 2 < target - epochs * source_size)::BIGINT ELSE 0 END * size)::BIGINT AS taken
FROM ordered
"""


@query("op4_source_mixing", MIX_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.drawn(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "taken")


HOST_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
              ("com", "/fr/", "allow"), ("com", "/de/", "block"))
GLOBS = (("**.spam-farm.**", "block"), ("**.cheap-pills.**", "block"), ("**/**casino**", "block"), ("**/*.exe", "block"), ("**/login**", "block"))

URL_SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '^(?:.|\n)*?://((?:.|\n)*)$', 1), '') AS rest FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(h, p, verdict) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in HOST_RULES) + r"""),
best AS (
  SELECT page_id, max_by(h || p, length(h) + length(p)) AS rule, max_by(verdict, length(h) + length(p)) AS verdict
  FROM urls JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, host, path, rule,
       coalesce(verdict, CASE WHEN contains('.' || host || path, '.spam-farm.') OR contains('.' || host || path, '.cheap-pills.')
         OR regexp_matches('.' || host || path, '(?s)/.*casino|/[^/]*\.exe$|/login') THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u LEFT JOIN best USING (page_id)
"""


@query("op5_url_filters", URL_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_rules.host_rule(*r) for r in HOST_RULES] + [url_rules.glob_rule(*g) for g in GLOBS]
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


@query("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_files(table(spark, sf_dir, "documents"))


def _canonical_sql(text: str) -> str:
    """Every word between blanks of its own, spellings replaced one after the other, blanks squeezed at the end."""
    plain = f"' ' || regexp_replace(regexp_replace(lower({text}), '{licenses.COPYRIGHT_LINE}', ' ', 'g'), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' '"
    ways = [*((a, b) for a, b in licenses.SPELLINGS), *((f"{a}  {b}", one) for a, b, one in licenses.PAIRS)]
    return "trim(regexp_replace(" + reduce(lambda c, pair: f"replace({c}, ' {pair[0]} ', ' {pair[1]} ')", ways, plain) + ", ' +', ' ', 'g'))"


LICENSE_SQL = f"""
WITH texts(license, t) AS (VALUES {', '.join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in licenses.KNOWN)}),
known AS (SELECT md5({_canonical_sql('t')}) AS digest, min(license) AS license, max(length(t) - length(replace(t, chr(10), '')) + 1) AS lines FROM texts GROUP BY 1),
lined AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line, unnest(string_split(text, chr(10))) AS x FROM documents WHERE text IS NOT NULL),
solid AS (SELECT doc_id, line, x, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS place, lead(line) OVER (PARTITION BY doc_id ORDER BY line) - line AS gap
          FROM lined WHERE {_canonical_sql('x')} <> ''),
ends AS (SELECT doc_id, place, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS e FROM solid WHERE gap IS NULL OR gap > 1),
paragraph AS (SELECT s.doc_id, s.place, (SELECT min(e) FROM ends n WHERE n.doc_id = s.doc_id AND n.place >= s.place) AS e FROM solid s),
most AS (SELECT max(lines) AS n FROM known),
spans AS (
  SELECT s.doc_id, s.place, s.place + k AS last FROM solid s, most, unnest(range(0, n)) u(k)
  UNION SELECT p.doc_id, p.place, e.place FROM paragraph p JOIN ends e ON e.doc_id = p.doc_id AND e.e >= p.e, most WHERE e.e < p.e + n),
held AS (SELECT doc_id, list(x ORDER BY place) AS xs, list(line ORDER BY place) AS numbers FROM solid GROUP BY doc_id),
units AS (
  SELECT doc_id, 0 AS line, text AS unit FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, numbers[place], array_to_string(xs[place:last], chr(10)) FROM spans JOIN held USING (doc_id) WHERE last <= len(xs))
SELECT doc_id, license, min(line) = 0 AS whole, min(line)::INT AS first_line
FROM (SELECT doc_id, line, md5({_canonical_sql('unit')}) AS digest FROM units) JOIN known USING (digest) GROUP BY doc_id, license
"""


@query("op7_license_scans", LICENSE_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_neighbours.classify(docs, quality_neighbours.train(docs, table(spark, sf_dir, "labels")))


def vocabulary() -> str:
    """The byte-level vocabulary's file, from the installed package of public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, vocabulary())
    return token_files.read(spark, folder, with_ids=False)


# crc32 of an ASCII text `k`, from the list `crc_list` of the 256 remainders in the one row of `crc_table`
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_list)"""


def _crc_sql(codes: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: "
            "xor(c >> 8, crc_list[(xor(c, b) & 255) + 1])), 4294967295)")


def _edit_sql(state: str, letter: str, cost: str, line: str | None) -> str:
    """A path (cost, audit, text) with one more edit; nothing where there is no path."""
    text = f"{state}.t" if line is None else f"{state}.t || {line} || chr(10)"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"


def _inserted_sql(source: str) -> str:
    """Up to two insertions after the paths v0 to v3 (empty, after system, after user, after assistant)."""
    once = (f"SELECT *, least(v2, {', '.join(_edit_sql(v, 'I', '2', chr(39) + 'user:' + chr(39)) for v in ('v0', 'v1', 'v3'))}) AS i2, "
            f"least(v3, {_edit_sql('v2', 'I', '2', chr(39) + 'assistant:' + chr(39))}) AS i3 FROM {source}")
    return (f"SELECT * REPLACE (least(i2, {_edit_sql('i3', 'I', '2', chr(39) + 'user:' + chr(39))}) AS v2, "
            f"least(i3, {_edit_sql('i2', 'I', '2', chr(39) + 'assistant:' + chr(39))}) AS v3) FROM ({once})")


def _row_sql(state: str, keeps: str, role: str) -> str:
    """The ways to keep a row, or to give it a role, after a path."""
    kept = _edit_sql(state, "K", "cut", "role || ':' || text")
    given = _edit_sql(state, "R", "2 + cut", f"'{role}:' || text")
    return f"CASE WHEN NOT gone AND initial = '{keeps}' THEN {kept} END, CASE WHEN NOT gone THEN {given} END"


REPAIR_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_sql("list_transform(range(length(k)), lambda i: ord(k[i + 1])::BIGINT)")} % 20 AS fault
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations), crc_table),
damage AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed WHERE fault <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damage),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS open
  FROM ordered),
judged AS (
  SELECT *, blank OR again AS gone, (NOT blank AND NOT again AND open)::BIGINT AS cut, substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
sums AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, sum(blank::INT) AS blank, sum((again AND NOT blank)::INT) AS duplicate,
         sum(cut) AS truncated, sum(coalesce(before || initial NOT IN ('su', 'ua', 'au'), false)::INT) AS illegal, max(i) AS last
  FROM judged GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS v0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS v1,
         NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS v2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS v3 FROM sums
  UNION ALL
  SELECT w.conv_id, w.i + 1, {_edit_sql('v0', 'D', '3', None)},
         least({_edit_sql('v1', 'D', '3', None)}, CASE WHEN NOT gone AND initial = 's' THEN {_edit_sql('v0', 'K', 'cut', "role || ':' || text")} END),
         least({_edit_sql('v2', 'D', '3', None)}, {', '.join(_row_sql(v, 'u', 'user') for v in ('v0', 'v1', 'v3'))}),
         least({_edit_sql('v3', 'D', '3', None)}, {_row_sql('v2', 'a', 'assistant')})
  FROM ({_inserted_sql('walk')}) w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = w.i + 1),
ends AS (
  SELECT w.conv_id, least(v0, v3) AS v
  FROM ({_inserted_sql('walk')}) w JOIN sums s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.i = s.last)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.c, 0)::BIGINT AS cost,
       coalesce(v.a, '') AS audit, sha256(coalesce(v.t[1:length(v.t) - 1], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums s ON o.conv_id IS NOT DISTINCT FROM s.conv_id LEFT JOIN ends e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op11_conversation_repair", REPAIR_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_reports(table(spark, sf_dir, "conversations"))


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return languages.predict(docs, languages.train(docs))


SPELLING_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
found AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, {_crc_sql("list_transform(range(length(k) // 2), lambda i: ('0x' || substr(k, 2 * i + 1, 2))::BIGINT)")} AS h
  FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, ' ') || ':' || run)) AS k FROM found WHERE length(run) >= {spelling.SHORTEST}), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % {spelling.PLANTED} = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING sum(n) >= {spelling.LEAST}),
masks AS (SELECT word, unnest(list_transform(range(length(word)), lambda p: word[1:p] || '*' || word[p + 2:])) AS mask FROM words),
less AS (SELECT DISTINCT word, replace(mask, '*', '') AS shorter FROM masks),
pairs AS (
  SELECT a.word, b.word AS other FROM masks a JOIN masks b ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT l.word, shorter FROM less l JOIN words w ON shorter = w.word
  UNION ALL SELECT shorter, l.word FROM less l JOIN words w ON shorter = w.word),
nears AS (
  SELECT p.word, count(*) AS n_near, max(w.n) AS most, min_by(other, (-w.n, encode(other))) AS best FROM pairs p JOIN words w ON other = w.word GROUP BY p.word),
forms AS (
  SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= {spelling.RATIO} * n THEN best END AS form,
         CASE WHEN most >= {spelling.RATIO} * n THEN most END AS form_n FROM words w LEFT JOIN nears USING (word)),
ways AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT v.word, f.form FROM ways v JOIN forms f ON v.root = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT v.word, v.root FROM ways v JOIN forms f ON v.root = f.word WHERE f.form IS NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM forms f LEFT JOIN roots r ON f.word = r.word
"""


@query("op13_spelling_variants", SPELLING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(table(spark, sf_dir, "documents"), errors=True))
