"""Quality rules, line first.

Every line is judged by itself: it must end like a sentence, not be navigation
(separator marks between words), not be laden with symbols, not shout, and not
be a boilerplate notice (in four languages); a line equal to an earlier one goes as well. What is
left is the cleaned text, and a document that lost too large a share of its
words is rejected. All of it is column expressions over arrays inside one row:
no shuffle and no Python.

Edge cases: a null text has no words, so it fails the base rule and its cleaned
text is empty; lines without a word are dropped from the cleaned text and count
for nothing; very long texts are arrays of their own row only; repeated rows
are judged each; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
# Fixed values of the base rule.
MIN_WORDS = 50
REPEAT_PERCENT = 50
# Line rules.
ENDS = list(".!?…。！？")
CLOSERS = "\"'”’»)]"
SENTENCE_END = r"[.!?…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$"
SEPARATORS = ["|", ">", "»", "•", "·", "/", "::"]
#: Notices in English, French, German and Spanish; each stands at the start of a word.
NOTICES = [
    "all rights reserved", "copyright", "cookie", "privacy policy", "terms of use", "terms of service", "javascript", "subscribe",
    "unsubscribe", "sign in", "sign up", "login", "log in", "powered by", "click here", "license under", "licensed under",
    "licence under", "licenced under",
    "tous droits réservés", "mentions légales", "politique de confidentialité", "conditions d'utilisation",
    "conditions d’utilisation", "se connecter", "connectez-vous", "abonnez-vous", "inscrivez-vous", "cliquez ici",
    "alle rechte vorbehalten", "impressum", "datenschutz", "nutzungsbedingungen", "jetzt anmelden", "einloggen",
    "newsletter abonnieren", "hier klicken",
    "todos los derechos reservados", "aviso legal", "política de privacidad", "términos de uso", "condiciones de uso",
    "iniciar sesión", "inicia sesión", "suscríbete", "haz clic aquí"]
BOILERPLATE = rf"©|(?:^|[^a-z])(?:{'|'.join(NOTICES)}|under the [a-z0-9 -]+ licen[cs]e)"
#: What a line must contain for ``BOILERPLATE`` to match; plain searches are far cheaper.
HINTS = ["©", "licen", *NOTICES]
BOILERPLATE_WORDS = 30
SHOUT_WORDS = 3
LOST_PERCENT = 50


def words_in(line: Column) -> Column:
    for space in "\t\n\x0b\x0c\r":
        line = F.replace(line, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(line, " "), "")


def symbols_in(line: Column) -> Column:
    """How many characters of ``SYMBOL`` a line has; each is one byte."""
    return reduce(lambda x, y: x + y, (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(s), F.lit("")))
                                       for s in SYMBOL.strip("[]")))


def line_passes(line: Column, low: Column, n: Column) -> Column:
    """The line rules over one line of ``n`` words, at least one; ``low`` is the
    line in lower case. Plain searches come first; a line that fails a rule is
    not read by the next."""
    end = F.rtrim(F.rtrim(line, F.lit(" \t\n\x0b\x0c\r")), F.lit(CLOSERS))
    sentence = any_of(F.endswith(end, F.lit(e)) for e in ENDS)
    navigation = any_of(F.contains(line, F.lit(s)) for s in SEPARATORS) & (
        F.size(F.filter(words_in(line), lambda w: w.isin(SEPARATORS))) * 5 > n)
    symbols = symbols_in(line) * 4 > n
    shouting = (n >= SHOUT_WORDS) & (F.length(F.regexp_replace(line, r"\P{Lu}+", "")) * 2
                                     > F.length(F.regexp_replace(line, r"\P{L}+", "")))
    boilerplate = (n <= BOILERPLATE_WORDS) & any_of(F.contains(low, F.lit(h)) for h in HINTS) & low.rlike(BOILERPLATE)
    return sentence & ~navigation & ~symbols & ~shouting & ~boilerplate


def any_of(tests) -> Column:
    return reduce(lambda x, y: x | y, tests)


def repeat_words(words: str) -> list[tuple[str, Column]]:
    """Steps that count the words lying in a 3-word window found twice or more:
    where the windows' hashes are not all different, sort them, keep the places
    of equal neighbours, and add up what each place covers before the next."""
    n = F.size(words)
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = F.transform(F.slice("_h", F.lit(1), F.greatest(n - 2, F.lit(0))),
                          lambda h, i: F.xxhash64(h, F.col("_h")[i + 1], F.col("_h")[i + 2]))
    placed = F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.sort_array(
        F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none)
    size = F.size("_s")
    pairs = F.when(size >= 2, F.zip_with(
        F.slice("_s", F.lit(1), F.greatest(size - 1, F.lit(0))), F.slice("_s", F.lit(2), F.greatest(size - 1, F.lit(0))),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>"))))
    m = F.size("_p")
    covered = F.when(m > 0, F.aggregate(F.zip_with(
        F.slice("_p", F.lit(1), F.greatest(m - 1, F.lit(0))), F.slice("_p", F.lit(2), F.greatest(m - 1, F.lit(0))),
        lambda x, y: F.least(y - x, F.lit(3))), F.lit(3), lambda a, b: a + b)).otherwise(0)
    return [("_h", hashes), ("_w", windows), ("_s", placed),
            ("_p", F.sort_array(F.array_distinct(F.flatten(F.coalesce(pairs, F.array().cast("array<array<int>>")))))),
            ("n_repeat_words", covered.cast("long"))]


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept_words, kept and the cleaned
    ``text`` (the lines that passed)."""
    c = F.col
    text = F.coalesce(c("text"), F.lit(""))
    out = docs.select("doc_id", text.alias("text"))
    out = out.withColumn("_words", words_in(c("text")))
    out = out.withColumn("_lines", F.filter(F.split("text", "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("_once", F.array_distinct("_lines"))
    lines = F.transform("_once", lambda l: F.struct(l.alias("line"), F.lower(l).alias("low"), F.size(words_in(l)).alias("n")))
    out = out.withColumn("_kept", F.filter(lines, lambda l: line_passes(l["line"], l["low"], l["n"])))
    for name, step in repeat_words("_words"):
        out = out.withColumn(name, step)
    kept_words = F.aggregate("_kept", F.lit(0), lambda a, l: a + l["n"])
    out = out.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        symbols_in(c("text")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size("_once")).cast("long").alias("n_dup_lines"),
        "n_repeat_words", kept_words.cast("long").alias("kept_words"),
        F.array_join("_kept.line", "\n").alias("text"))
    failed = (c("n_words") < MIN_WORDS) | (c("n_repeat_words") * 100 > c("n_words") * REPEAT_PERCENT)
    lost = (c("n_words") - c("kept_words")) * 100 > c("n_words") * LOST_PERCENT
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~lost)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), {_sql(SPACE)}), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d)),
rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words
        FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM win WHERE c > 1) GROUP BY 1),
ln AS (SELECT DISTINCT doc_id, l FROM (SELECT doc_id, unnest(ls) AS l FROM d)),
lw AS (SELECT doc_id, l, list_filter(regexp_split_to_array(l, {_sql(SPACE)}), lambda x: x <> '') AS w FROM ln),
ok AS (
  SELECT doc_id, sum(len(w)) AS kept_words FROM lw
  WHERE regexp_matches(l, {_sql(SENTENCE_END)})
    AND NOT len(list_filter(w, lambda x: x IN ({", ".join(map(_sql, SEPARATORS))}))) * 5 > len(w)
    AND NOT len(regexp_extract_all(l, {_sql(SYMBOL)})) * 4 > len(w)
    AND NOT (len(w) >= {SHOUT_WORDS} AND len(regexp_extract_all(l, '\p{{Lu}}')) * 2 > len(regexp_extract_all(l, '\p{{L}}')))
    AND NOT (len(w) <= {BOILERPLATE_WORDS} AND regexp_matches(lower(l), {_sql(BOILERPLATE)}))
  GROUP BY 1),
n AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, {_sql(SPACE)}, '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, {_sql(SYMBOL)})) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(kept_words, 0) AS BIGINT) AS kept_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN ok USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_PERCENT} AS base_failed,
       NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_PERCENT})
       AND NOT (n_words - kept_words) * 100 > n_words * {LOST_PERCENT} AS kept
FROM n
"""
