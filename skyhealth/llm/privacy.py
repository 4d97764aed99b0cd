"""Personal data: patterns, and terms that give the found entities away.

The base patterns find e-mail addresses, IP addresses, card and phone numbers;
each distinct value is a protected entity e. A term t that lies near e (within
``WINDOW`` characters of a mention, in whole words) may reveal it. How strongly
is estimated over the whole corpus: with documents N, those with e d(e), those
with t d(t) and those with t near e c, the information t gives of e is
log(N c / (d(e) d(t))), out of the log(N / d(e)) that e holds. A term that
discloses half of it or more, seen in ``MIN_DOCS`` documents at least, is
generalised to its class (its first ``CLASS_CHARS`` characters and a star) if
the class discloses less than half, and removed if it does not. The half is
decided in integers: N c^2 >= d(e) d(t)^2.

All of it is column expressions: no Python touches a row. Texts are read twice,
by the patterns and to count the documents of every term (summed map-side, a
row a term and task). Only mentions and their windows are shuffled; documents
of the same text are folded first, with their number.

Edge cases: a null text is empty; an empty text has no span and the digest of
nothing; repeated rows are documents each and get the same spans; positions are
code points, and the time for a very long text is linear in it (prefix sums are
taken in blocks); a window ends at the next match of its pattern, and a word
that touches a match or the window's end is left out; where two entities of a
document disagree over a term it is removed; an empty table gives no rows;
columns of any name are carried in one struct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.llm.common import LOWER, UPPER, staged, unpacked

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "general", "remove"]
GENERAL, REMOVE = 4, 5
#: The patterns of the base rule. Each matches just what the rule's own pattern
#: would: a match can only begin where a run of its characters does (or where the
#: last match ended), so a failed run is not tried again from its middle, and
#: possessive repeats never give back. The card pattern counts digits as well.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?:\.|$)){4}$"
SPACE = r"\x20\x09-\x0D"
PUNCT = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
#: Group 1 is the term of a word that is letters but for punctuation around them.
TERM = rf"(?<![^{SPACE}]){PUNCT}*+({LETTER}++){PUNCT}*+(?![^{SPACE}])"
WINDOW = 100
CLASS_CHARS = 3
MIN_DOCS = 2
#: Stands for what adjoins a window; a word with it is no term.
MARK = "0"
_BLOCK = 256
_LABELS = {**{k: f"[{k.upper()}]" for k in BASE}, "remove": "[TERM]"}


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def before_each(sizes: Column) -> Column:
    """Sums of all that come before each number of an array, in blocks, so
    that the work is near linear in its length."""
    add = lambda a, x: a + x                                              # noqa: E731
    zero = F.lit(0).cast("long")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK)))
    totals = F.transform(blocks, lambda x: F.aggregate(x, zero, add))
    offsets = F.transform(totals, lambda t, i: F.aggregate(F.slice(totals, F.lit(1), i), zero, add))
    return F.when(F.size(sizes) > 0, F.flatten(F.zip_with(blocks, offsets, lambda x, o: F.transform(
        x, lambda y, i: o + F.aggregate(F.slice(x, F.lit(1), i), zero, add))))).otherwise(F.array().cast("array<long>"))


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(IP_PARTS)
    if kind == "card":
        return F.call_function("luhn_check", F.regexp_replace(match, r"[\x20-]", ""))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _entity(kind: str, match: Column) -> Column:
    value = match if kind == "ip" else _lower(match) if kind == "email" else F.regexp_replace(match, "[^0-9]", "")
    return F.concat(F.lit(f"{kind}:"), value)


def _span(k: int, kind: str, m: str, g: str, at: str) -> Callable[[Column, Column], Column]:
    """A match of array ``m`` by number i, with ``g`` between the matches and
    the sums ``at``, as a struct."""
    def mark(when: Column) -> Column:
        return F.when(when, F.lit(MARK)).otherwise(F.lit(""))

    def of(match: Column, i: Column) -> Column:
        left, right = F.get(g, i), F.get(g, i + 1)
        start = F.get(at, i) + F.length(left)
        end = start + F.length(match)
        open_left = (i > 0) | (F.length(left) > WINDOW)
        open_right = (i + 1 < F.size(m)) | (F.length(right) > WINDOW)
        return F.struct(
            F.lit(k).alias("kind"), start.alias("start"), end.alias("end"), _entity(kind, match).alias("entity"),
            F.concat(mark(open_left), F.right(left, F.lit(WINDOW)), F.lit(MARK)).alias("before"),
            (start - F.least(F.length(left), F.lit(WINDOW)) - open_left.cast("int")).alias("before_at"),
            F.concat(F.lit(MARK), F.left(right, F.lit(WINDOW)), mark(open_right)).alias("after"),
            (end - 1).alias("after_at"), _valid(kind, match).alias("valid"))

    return of


def mentions(rows: DataFrame) -> DataFrame:
    """Adds ``_found``: every base span of ``text`` with its entity and the
    windows before and after it, in order of kind and start."""
    c = F.col
    parts = []
    for k, kind in enumerate(BASE):
        m, g, at = f"_m{k}", f"_g{k}", f"_s{k}"
        rows = rows.withColumn(m, F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0)))
        # What lies between the matches; the start of a match is the length of all before it.
        rows = rows.withColumn(g, F.when(F.size(m) > 0, F.split("text", PATTERNS[kind])).otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn(at, F.zip_with(F.slice(g, F.lit(1), F.size(m)), m, lambda a, b: F.length(a) + F.length(b)))
        rows = rows.withColumn(at, before_each(c(at)))

        rows = rows.withColumn(at, F.filter(F.transform(m, _span(k, kind, m, g, at)), lambda s: s["valid"]))
        parts.append(at)
    return rows.withColumn("_found", F.concat(*parts)).drop(*[f"_{x}{k}" for x in "mgs" for k in range(len(BASE))])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def near(windows: DataFrame) -> DataFrame:
    """digest, n, entity, term, start and end of every term in the windows of
    the mentions in ``_found``."""
    c = F.col
    word = rf"[^{SPACE}]+"
    rows = windows.select("digest", "n", F.explode("_found").alias("f")).select(
        "digest", "n", "f.entity", F.inline(F.array(F.struct(c("f.before").alias("w"), c("f.before_at").alias("at")),
                                                     F.struct(c("f.after").alias("w"), c("f.after_at").alias("at")))))
    rows = rows.withColumn("words", F.regexp_extract_all("w", F.lit(word), F.lit(0))).withColumn("gaps", F.split("w", word))
    rows = rows.withColumn("starts", F.transform("words", lambda w, i: c("at") + F.aggregate(
        F.slice("gaps", F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(
        F.slice("words", F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x))))
    rows = rows.select("digest", "n", "entity", F.inline(F.arrays_zip(c("words").alias("word"), c("starts").alias("start"))))
    rows = rows.where(c("word").rlike(rf"^{PUNCT}*+{LETTER}++{PUNCT}*+$"))
    term = F.regexp_extract("word", rf"{LETTER}+", 0)
    start = c("start") + F.length(F.regexp_extract("word", rf"^{PUNCT}*", 0))
    return rows.select("digest", "n", "entity", _lower(term).alias("term"), start.alias("start"), (start + F.length(term)).alias("end"))


def class_of(term: Column) -> Column:
    """A term's class, null where the term is no longer than that."""
    return F.when(F.length(term) > CLASS_CHARS, F.concat(F.left(term, F.lit(CLASS_CHARS)), F.lit("*")))


def documents_of_terms(docs: DataFrame) -> DataFrame:
    """key (a term or a class) and d, the number of documents that hold it."""
    found = docs.select(F.array_distinct(F.regexp_extract_all(_lower(F.col("text")), F.lit(TERM), F.lit(1))).alias("t"))
    classes = F.array_distinct(F.transform(F.filter("t", lambda t: F.length(t) > CLASS_CHARS), class_of))
    return found.select(F.explode(F.concat("t", classes)).alias("key")).groupBy("key").agg(F.count("*").alias("d"))


def verdicts(windows: DataFrame, words: DataFrame, docs: DataFrame, total: int) -> DataFrame:
    """entity, term and kind (general or remove) of the terms that disclose too
    much of an entity."""
    c = F.col
    entities = windows.select("digest", "n", F.explode(F.array_distinct(F.transform("_found", lambda f: f["entity"]))).alias("entity"))
    entities = entities.groupBy("entity").agg(F.sum("n").alias("e"))
    keys = words.select("digest", "n", "entity", F.explode(F.array_compact(F.array(c("term"), class_of(c("term"))))).alias("key"))
    pairs = keys.groupBy("digest", "entity", "key").agg(F.max("n").alias("n")).groupBy("entity", "key").agg(F.sum("n").alias("c"))
    pairs = pairs.where(c("c") >= MIN_DOCS).join(entities, "entity").join(documents_of_terms(docs), "key")
    big = lambda x: x.cast("decimal(12,0)")                               # noqa: E731  three of them fit 38 digits
    # Written once: terms and classes below would each count the corpus again.
    pairs = staged(pairs.where(
        big(F.lit(total)) * big(c("c")) * big(c("c")) >= big(c("e")) * big(c("d")) * big(c("d"))).select("entity", "key"), "disclosed")
    is_class = c("key").endswith("*")
    terms = pairs.where(~is_class).select("entity", c("key").alias("term"), class_of(c("key")).alias("class"))
    classes = pairs.where(is_class).select("entity", c("key").alias("class"), F.lit(True).alias("told"))
    return terms.join(classes, ["entity", "class"], "left").select(
        "entity", "term", F.when(c("class").isNotNull() & c("told").isNull(), GENERAL).otherwise(REMOVE).alias("kind"))


def find(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns), n_email, n_ip, n_card,
    n_phone, base_sha256, ``found`` (all spans: kind's number, start, end) and
    ``spans`` (the same as text) of every document."""
    c = F.col
    text = F.coalesce(c("text"), F.lit(""))
    rows = docs.select(F.struct(*[c(f"`{x}`") for x in keep]).alias("row"), text.alias("text"))
    rows = mentions(rows)
    rows = staged(rows.select("row", "_found", F.when(F.size("_found") > 0, F.sha2("text", 256)).alias("digest")), "mentions")
    hits = rows.where("digest IS NOT NULL")
    # A text's rows are one from here on; what depends on the text alone is the same in all.
    windows = staged(hits.groupBy("digest").agg(F.count("*").alias("n"), F.first("_found").alias("_found")), "windows")
    words = near(windows)
    texts = docs.select(text.alias("text"))
    told = verdicts(windows, words, texts, docs.count())
    marked = words.join(told, ["entity", "term"]).groupBy("digest", "start", "end").agg(F.max("kind").alias("kind"))
    # One row a text, of spans in its own windows.
    marked = marked.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("more"))
    base = F.transform("_found", lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    clean = rows.where("digest IS NULL").select("row", "_found", base.alias("base"), none.alias("more"))
    # No hint: AQE splits a digest that many rows share.
    dirty = hits.join(marked, "digest", "left").select("row", "_found", base.alias("base"), F.coalesce("more", none).alias("more"))
    every = clean.unionByName(dirty).withColumn("found", F.concat("base", "more"))
    count: Callable[[int], Column] = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return every.select("row", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
                        F.sha2(joined(c("base")), 256).alias("base_sha256"), "found", joined(c("found")).alias("spans"))


def rewritten(text: Column, found: Column) -> Column:
    """The text with every span replaced: base spans and removed terms by a
    label, generalised ones by their class. Of spans that overlap the first
    gives the label for all they cover."""
    labels = F.array(*[F.lit(_LABELS.get(k, "")) for k in KINDS])
    order = F.sort_array(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    take = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))

    def step(done: Column, s: Column) -> Column:
        label = F.when(s["kind"] == GENERAL, F.concat(take(s["start"], s["start"] + CLASS_CHARS), F.lit("*"))).otherwise(F.get(labels, s["kind"]))
        new = F.when(s["start"] >= done["at"], F.array(take(done["at"], s["start"]), label)).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["parts"], new).alias("parts"))

    return F.aggregate(order, start, step, lambda d: F.concat(F.array_join(d["parts"], ""), F.substring(
        text, (d["at"] + 1).cast("int"), F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with personal data and the terms that disclose it taken
    out of ``text``; a null text stays null."""
    done = find(docs, docs.columns)
    text = F.when(F.size("found") > 0, rewritten(F.col("row.text"), F.col("found"))).otherwise(F.col("row.text"))
    return unpacked(done.withColumn("row", F.col("row").withField("text", text)), docs.columns)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _kind_sql(k: int, kind: str, pattern: str, valid: str, entity: str) -> str:
    return f"""
k{k} AS (
  SELECT id, {k} AS kind, s AS start, s + length(m) AS "end", {entity} AS entity,
         CASE WHEN i > 1 OR length(l) > {WINDOW} THEN '{MARK}' ELSE '' END || right(l, {WINDOW}) || '{MARK}' AS before,
         s - least(length(l), {WINDOW}) - CASE WHEN i > 1 OR length(l) > {WINDOW} THEN 1 ELSE 0 END AS before_at,
         '{MARK}' || left(r, {WINDOW}) || CASE WHEN i < n OR length(r) > {WINDOW} THEN '{MARK}' ELSE '' END AS after,
         s + length(m) - 1 AS after_at
  FROM (
    SELECT id, i, len(m) AS n, m[i] AS m, g[i] AS l, g[i + 1] AS r,
           list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT id, regexp_extract_all(text, {_sql(pattern)}) AS m, regexp_split_to_array(text, {_sql(pattern)}) AS g FROM d)))
  WHERE {valid})"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (f"length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda j: "
         f"CASE WHEN j % 2 = 1 THEN CAST({_DIGITS}[-j] AS INT) WHEN CAST({_DIGITS}[-j] AS INT) > 4 "
         f"THEN 2 * CAST({_DIGITS}[-j] AS INT) - 9 ELSE 2 * CAST({_DIGITS}[-j] AS INT) END)) % 10 = 0")
_OCTETS = ("len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 "
           "OR CAST(coalesce(nullif(left(ltrim(p, '0'), 4), ''), '0') AS INT) > 255)) = 0")
_LOWERED = f"translate(%s, '{UPPER}', '{LOWER}')"
_NAMES = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
{_kind_sql(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", "'email:' || " + _LOWERED % "m")},
{_kind_sql(1, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", _OCTETS, "'ip:' || m")},
{_kind_sql(2, "card", r"[0-9](?:[\x20-]?[0-9])+", _LUHN, f"'card:' || {_DIGITS}")},
{_kind_sql(3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15", f"'phone:' || {_DIGITS}")},
f AS (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3),
win AS (SELECT id, entity, before AS w, before_at AS off FROM f UNION ALL SELECT id, entity, after, after_at FROM f),
wd AS (
  SELECT id, entity, ws[i] AS word,
         off + list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ws[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT id, entity, off, ws, gs, unnest(range(1, len(ws) + 1)) AS i FROM (
    SELECT id, entity, off, regexp_extract_all(w, '[^{SPACE}]+') AS ws, regexp_split_to_array(w, '[^{SPACE}]+') AS gs FROM win))),
nr AS (
  SELECT id, entity, {_LOWERED % f"regexp_extract(word, {_sql(LETTER + '+')})"} AS term,
         start + length(regexp_extract(word, {_sql('^' + PUNCT + '*')})) AS start
  FROM wd WHERE regexp_matches(word, {_sql(f'^{PUNCT}*{LETTER}+{PUNCT}*$')})),
cl AS (SELECT *, CASE WHEN length(term) > {CLASS_CHARS} THEN left(term, {CLASS_CHARS}) || '*' END AS class FROM nr),
tot AS (SELECT count(*) AS n FROM d),
de AS (SELECT entity, count(DISTINCT id) AS e FROM f GROUP BY 1),
tm AS (
  SELECT id, list_distinct(list_transform(
           list_filter(regexp_extract_all({_LOWERED % "text"}, '[^{SPACE}]+'), lambda w: regexp_matches(w, {_sql(f'^{PUNCT}*{LETTER}+{PUNCT}*$')})),
           lambda w: regexp_extract(w, {_sql(LETTER + '+')}))) AS t FROM d),
dt AS (
  SELECT key, count(*) AS d FROM (
    SELECT unnest(t) AS key FROM tm UNION ALL
    SELECT unnest(list_distinct(list_transform(list_filter(t, lambda x: length(x) > {CLASS_CHARS}), lambda x: left(x, {CLASS_CHARS}) || '*'))) FROM tm)
  GROUP BY 1),
pr AS (
  SELECT entity, key, count(DISTINCT id) AS c FROM (
    SELECT id, entity, term AS key FROM cl UNION ALL SELECT id, entity, class FROM cl WHERE class IS NOT NULL)
  GROUP BY 1, 2),
told AS (
  SELECT entity, key FROM pr JOIN de USING (entity) JOIN dt USING (key), tot
  WHERE c >= {MIN_DOCS} AND CAST(n AS HUGEINT) * c * c >= CAST(e AS HUGEINT) * d * d),
mk AS (
  SELECT id, start, start + length(cl.term) AS "end",
         max(CASE WHEN class IS NOT NULL AND k.key IS NULL THEN {GENERAL} ELSE {REMOVE} END) AS kind
  FROM cl JOIN told t ON t.entity = cl.entity AND t.key = cl.term LEFT JOIN told k ON k.entity = cl.entity AND k.key = cl.class
  GROUP BY 1, 2, 3),
sp AS (SELECT id, kind, start, "end" FROM f UNION ALL SELECT id, kind, start, "end" FROM mk),
ag AS (
  SELECT id, count_if(kind = 0) AS n_email, count_if(kind = 1) AS n_ip, count_if(kind = 2) AS n_card, count_if(kind = 3) AS n_phone,
         coalesce(string_agg(({_NAMES})[kind + 1] || ':' || start || ':' || "end", ',' ORDER BY kind, start) FILTER (kind < {GENERAL}), '') AS b,
         string_agg(({_NAMES})[kind + 1] || ':' || start || ':' || "end", ',' ORDER BY kind, start) AS spans
  FROM sp GROUP BY 1)
SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip,
       CAST(coalesce(n_card, 0) AS BIGINT) AS n_card, CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN ag USING (id)
"""
