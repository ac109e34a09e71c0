"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Base spans are found by regular expressions. The corpus tells how strongly a term t reveals
a protected entity e (a base value). With N documents, n(t) documents that hold t, n(e)
documents that hold e and n(e, t) documents that hold both, anywhere in the text,

    disclosure(t, e) = PMI(e; t) / IC(e) = 1 + log2(min(1, n(e, t) / n(t))) / log2(N / n(e))

is 1 if t never occurs without e and falls to 0 if t says nothing about e. A term discloses
if the ratio reaches ``DISCLOSES`` and at least ``SUPPORT`` different contexts show the pair. A
context is the words within ``REACH`` code points on either side of a mention (of several in
a document the one of lowest hash), so copies of one passage count once and prove nothing. All
occurrences of a disclosing term in each document that holds its entity become ``term``
spans: from ``REMOVES`` on they are removed, below generalised.

All counts cover the whole corpus. Words are paired only with entities of enough contexts, and
pairs are merged before each shuffle (partial aggregation over entity, term and context).

Cases: a null text has no spans and stays null when redacted; an empty table gives an empty
result; repeated rows each give a row; a null doc_id keeps its row; spans of one start go by
kind as listed, then end; ``find`` reads the two named columns only, ``redact`` keeps all
columns of its input under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import common

KINDS = ("email", "ip", "card", "phone", "term")
REACH = 60
SUPPORT = 3
DISCLOSES = 0.75
REMOVES = 0.95
#: The texts with disclosing terms are broadcast up to this many, else shuffled.
BROADCAST_ROWS = 20_000
#: Letters of a term, at least.
TERM_LETTERS = 3

# A match can only start where a run of its characters starts or the last match ended, which
# spares a new try at each character of long runs. Possessive loops need neither stack nor
# backtracking. A chain of under 14 digits is no card and holds none.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
_TERM = rf"(?<=[^\p{{L}}\p{{N}}])\p{{L}}{{{TERM_LETTERS},}}+(?=[^\p{{L}}\p{{N}}])"
_WORD = rf"\p{{L}}{{{TERM_LETTERS},}}+"
_SPAN = "struct<start:int,kind:int,end:int,value:string>"
_PLACED = "array<struct<start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of the pattern is of its kind."""
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _places(text: Column, pattern: str, matches: Column) -> Column:
    """Start, end and value of all matches: the texts between them give the places."""
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(matches)).alias("gap"), matches.alias("value"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast(_PLACED).alias("found"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(s["found"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("found"))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, state, step, lambda s: s["found"])).otherwise(
        F.array().cast(_PLACED))


def _of_kind(text: Column, kind: str, matches: Column) -> Column:
    placed = F.filter(_places(text, PATTERNS[kind], matches), lambda m: _holds(kind, m["value"]))
    return F.transform(placed, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"), m["value"].alias("value")))


_NEEDS = {"email": "@", "ip": ".", "phone": "+"}


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``base``, the sorted array of (start, kind, end, value)."""
    none = F.array().cast("array<string>")
    cols = {}
    for kind, pattern in PATTERNS.items():
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        cols[f"_{kind}"] = F.when(F.contains(F.col(text), F.lit(_NEEDS[kind])), hits).otherwise(none) if kind in _NEEDS else hits
    out = docs.withColumns(cols)
    spans = [_of_kind(F.col(text), kind, F.col(f"_{kind}")) for kind in PATTERNS]
    return out.withColumn("base", F.array_sort(F.concat(*spans)).cast(f"array<{_SPAN}>")).drop(*cols)


def _contexts(text: Column, base: Column) -> Column:
    """Per mention: entity, hash of the context's words, and its terms with their places."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))  # code point i of the text is at i + 1

    def terms(start: Column, end: Column) -> Column:
        piece = F.substring(padded, start + 1, end - start)  # from padded place ``start``, 0-based
        hits = F.regexp_extract_all(piece, F.lit(_TERM), F.lit(0))
        return F.transform(_places(piece, _TERM, hits), lambda m: F.struct(
            F.lower(m["value"]).alias("term"), (m["start"] + start - 1).alias("start"), (m["end"] + start - 1).alias("end")))

    def mention(s: Column) -> Column:
        # in padded places the mention is start + 1 .. end + 1; one more place on each side
        left, right = F.greatest(s["start"] - REACH, F.lit(0)), s["end"] + REACH + 2
        near = F.concat(terms(left, s["start"] + 2), terms(s["end"], right))
        near = F.filter(near, lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
        value = F.when(s["kind"] == 0, F.lower(s["value"])).when(s["kind"] == 1, s["value"]).otherwise(_digits(s["value"]))
        return F.struct(F.concat(s["kind"].cast("string"), F.lit(":"), value).alias("entity"),
                        F.xxhash64(F.transform(near, lambda t: t["term"])).alias("context"), near.alias("terms"))
    return F.transform(base, mention)


def _masked(text: Column, base: Column) -> Column:
    """The text with blanks in place of base spans."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        start, end = F.greatest(s["at"], x["start"]), F.greatest(s["at"], x["end"])
        return F.struct(end.alias("at"), F.concat(
            s["out"], F.substring(text, s["at"] + 1, start - s["at"]), F.repeat(F.lit(" "), end - start)).alias("out"))
    return F.aggregate(base, state, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def _held(found: DataFrame, *cols: str) -> DataFrame:
    """(cols, text, entity, context): a row per document and entity."""
    rows = found.where(F.size("contexts") > 0).withColumn("m", F.array_sort(F.transform(
        "contexts", lambda m: F.struct(m["entity"].alias("entity"), m["context"].alias("context")))))
    first = F.filter("m", lambda m, i: (i == 0) | (F.col("m")[F.greatest(i - 1, F.lit(0))]["entity"] != m["entity"]))
    return rows.select(*cols, "text", F.explode(first).alias("m")).select(*cols, "text", "m.entity", "m.context")


def _terms(text: Column) -> Column:
    hits = F.regexp_extract_all(F.concat(F.lit(" "), text, F.lit(" ")), F.lit(_TERM), F.lit(0))
    return F.array_distinct(F.transform(hits, lambda t: F.lower(t)))


def disclosing(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """(entity, term, disclosure) of all pairs that disclose. found: a row per document, with
    its contexts and, if it has any, its text."""
    n_docs = found.count()
    held = _held(found)
    by_entity = held.groupBy("entity", "context").agg(F.count("*").alias("n")).groupBy("entity").agg(
        F.sum("n").alias("n_entity"), F.count("*").alias("n_contexts")).where(
        (F.col("n_contexts") >= SUPPORT) & (F.col("n_entity") < n_docs)).drop("n_contexts")
    pairs = held.join(by_entity, "entity", "left_semi").select("entity", "context", F.explode(_terms(F.col("text"))).alias("term"))
    together = pairs.groupBy("entity", "term", "context").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(
        F.count("*").alias("support"), F.sum("n").alias("together")).where(F.col("support") >= SUPPORT)
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(_WORD), F.lit(0)))
    by_term = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    share = F.least(F.lit(1.0), F.col("together") / F.greatest(F.col("n_term"), F.lit(1)))
    content = F.log2(F.lit(float(max(n_docs, 1))) / F.col("n_entity"))
    rated = together.join(by_entity, "entity").join(by_term, "term", "left")
    return rated.select("entity", "term", (1 + F.log2(share) / content).alias("disclosure")).where(
        F.col("disclosure") >= DISCLOSES)


def _term_spans(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, terms): per text the sorted spans of disclosing terms, wherever they stand."""
    held = _held(found, "key").join(pairs.select("entity").distinct(), "entity", "left_semi")
    hits = held.select("key", "entity", F.explode(_terms(F.col("text"))).alias("term")).join(pairs, ["entity", "term"])
    rated = hits.groupBy("key", "term").agg(F.max("disclosure").alias("d")).groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "d"))).alias("rated"))
    texts = found.where(F.size("contexts") > 0).select("key", "text").join(rated, "key").dropDuplicates(["key"])
    padded = F.concat(F.lit(" "), F.col("text"), F.lit(" "))
    rows = texts.withColumn("words", F.regexp_extract_all(padded, F.lit(_TERM), F.lit(0))).withColumn(
        "gaps", F.slice(F.split(padded, _TERM, -1), 1, F.size("words")))
    state = F.struct(F.lit(-1).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["gaps"])
        end, d = start + F.length(x["words"]), F.try_element_at(F.col("rated"), F.lower(x["words"]))
        value = F.when(d >= REMOVES, F.lit("")).otherwise(F.lit("[WORD]"))
        span = F.struct(start.alias("start"), F.lit(KINDS.index("term")).alias("kind"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.when(d.isNull(), s["found"]).otherwise(
            F.concat(s["found"], F.array(span))).cast(f"array<{_SPAN}>").alias("found"))
    return rows.select("key", F.aggregate(F.arrays_zip("gaps", "words"), state, step, lambda s: s["found"]).alias("terms"))


def _key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def find(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, key, base) of every row, and (key, terms) of the texts with
    disclosing terms, where ``key`` is the text's digest."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spotted = base_spans(rows.withColumn("key", _key(F.col("text"))), "text")
    found = common.written(spark, spotted.select(
        "doc_id", "key", "base", F.transform(_contexts(F.col("text"), F.col("base")), lambda m: F.struct(
            m["entity"].alias("entity"), m["context"].alias("context"))).alias("contexts"),
        F.when(F.size("base") > 0, _masked(F.col("text"), F.col("base"))).alias("text")), "pii-found")
    pairs = disclosing(rows, found)
    return found.select("doc_id", "key", "base"), _term_spans(found, pairs)


def with_terms(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, key, base, spans): base and term spans together, sorted."""
    both = F.concat("base", F.coalesce("terms", F.array().cast(f"array<{_SPAN}>")))
    return found.join(terms, "key", "left").withColumn("spans", F.array_sort(both)).drop("terms")


def span_text(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each base span as a mark of its kind and each term span as its value;
    of spans that overlap the first writes its mark."""
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        mark = F.when(x["kind"] == KINDS.index("term"), x["value"]).otherwise(F.element_at(marks, x["kind"] + 1))
        fresh = F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), mark)
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"),
                        F.when(x["start"] >= s["at"], fresh).otherwise(s["out"]).alias("out"))
    whole = F.aggregate(spans, state, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in the text."""
    _, terms = find(spark, docs, id_col, text_col)
    terms = common.written(spark, terms, "pii-terms")
    if terms.count() <= BROADCAST_ROWS:
        terms = F.broadcast(terms)
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.col(text_col).isNull().alias("was_null")).withColumn("key", _key(F.col("text")))
    joined = base_spans(rows, "text").join(terms, "key", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("terms", F.array().cast(f"array<{_SPAN}>"))))
    clean = joined.withColumn("spans", spans).withColumn(
        "clean", F.when(~F.col("was_null"), redacted(F.col("text"), F.col("spans"))))
    return clean.select(*((F.col("clean") if c == text_col else F.col("row")[c]).alias(c) for c in names))
