"""Personal data: pattern spans, and terms that disclose the protected entities they occur with.

Pattern spans (e-mail, IP, card, phone) are found in whole texts. Each value found is a protected
entity, and so is the class it belongs to: its e-mail domain, network, issuer or dialling prefix, as a term
may give away whose data it is without giving away the value. The words of the texts that have an
entity are terms that may disclose it. All counts are of distinct texts, so copies
neither make a term telling nor hide it: of N texts n(e) have entity e, n(t) term t, n(t, e) both.

* certainty P(e | t) = n(t, e) / n(t),
* information in bits, log2 P(e | t) / P(e): how much less is left to guess of the entity,
* chance: by Chernoff's bound at most exp(-n(t) KL(P(e | t) || P(e))) that n(t) texts drawn from N have the
  entity n(t, e) times or more, times the number of pairs looked at.

Terms of at least ``CERTAINTY`` whose chance is at most ``LEVEL`` are generalised wherever they occur, in
texts without the entity too. No pair of an entity has less chance than (n(e) / N) ** n(e), so entities that
cannot come below the level drop out before terms are counted, and so do terms so common that no entity is as
frequent as certainty asks for.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import released, staged

KINDS = ("email", "ip", "card", "phone")
CERTAINTY = 0.5
LEVEL = 0.05
#: Leading parts that make a class: numbers of an address, digits of a card and of a phone number.
NETWORK, ISSUER, DIALLING = 2, 6, 5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that a long run without one costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches, by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(int(p[-4:]) <= 255 and not p[:-3].strip("0") for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def written(spans) -> str:
    return ",".join(f"{(*KINDS, 'term')[k]}:{a}:{b}" for a, k, b in spans)


_WORD = re.compile(r"[^\W\d_]+")


def words(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(lowered, start, end) of each run of letters that counts as a term and touches no span (by start)."""
    k, reach = 0, 0
    for m in _WORD.finditer(text):
        at = m.start()
        runs = [m[0]] if m[0].isalpha() else ["".join(g) for _, g in itertools.groupby(m[0], str.isalpha)]
        for run in runs:
            start, at = at, at + len(run)
            while k < len(spans) and spans[k][0] < at:
                reach = max(reach, spans[k][2])
                k += 1
            if reach <= start and run.isalpha():
                yield run.lower(), start, at


def protected(kind: int, value: str) -> tuple[str, str]:
    """A pattern match as an entity, and the class it belongs to."""
    if kind == 0:
        value = value.lower()
        return f"email:{value}", f"domain:{value.rpartition('@')[2]}"
    if kind == 1:
        parts = [str(int(p[-4:])) for p in value.split(".")]
        return f"ip:{'.'.join(parts)}", f"network:{'.'.join(parts[:NETWORK])}"
    digits = re.sub("[^0-9]", "", value)
    return (f"card:{digits}", f"issuer:{digits[:ISSUER]}") if kind == 2 else (f"phone:{digits}", f"dialling:{digits[:DIALLING]}")


_SCAN = "doc_id long, copy binary, base array<struct<start:int,kind:int,end:int>>, entities array<string>, terms array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bases, entities, terms = [], [], []
        for text in batch.column(1).to_pylist():
            spans = base_spans(text or "")
            bases.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
            own = set()
            for a, kind, b in spans:
                own.update(protected(kind, text[a:b]))
            entities.append(sorted(own))
            terms.append(sorted({w for w, _, _ in words(text, spans)}) if spans else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(bases, _SPANS), pa.array(entities, pa.list_(pa.string())), pa.array(terms, pa.list_(pa.string()))],
            names=["doc_id", "copy", "base", "entities", "terms"],
        )


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", copy_key().alias("copy"))


def copy_key() -> Column:
    """128 bits that equal texts share; null for a null text."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, copy (a hash of the text), base spans, entities, and the words of texts that have one, of every row."""
    return staged(_keyed(documents).mapInArrow(released(_scanned), _SCAN), "scan")


def surprise(n_te: Column, n_t: Column, n_e: Column, total: int) -> Column:
    """n(t) KL(P(e | t) || P(e)) in nats, which bounds the log chance from below; 0 if the entity is no more frequent beside the term."""
    p, q = n_te / n_t, n_e / F.lit(float(total))
    rest = F.when(n_te < n_t, (1 - p) * F.ln((1 - p) / (1 - q))).otherwise(0.0)
    return F.when(p > q, n_t * (p * F.ln(p / q) + rest)).otherwise(0.0)


def least_count(total: int, limit: float) -> int:
    """The smallest number of texts an entity must have for any of its terms to come below ``limit`` (a log); all of them if none can."""
    for n in range(1, 1 + int(total / math.e)):
        if n * math.log(total / n) >= -limit:
            return n
    return total


def telling_terms(documents: DataFrame, scanned: DataFrame, certainty: float = CERTAINTY, level: float = LEVEL) -> tuple[DataFrame, DataFrame]:
    """entity, term, bits of the pairs over the thresholds; and copy, term of all texts that have a term of some pair."""
    held = staged(scanned.where("size(entities) > 0").select("copy", "entities", "terms").dropDuplicates(["copy"]), "held")
    total = scanned.select("copy").distinct().count()
    tests = held.agg(F.sum(F.size("entities").cast("long") * F.size("terms"))).head()[0] or 0
    limit = math.log(level / max(1, tests))
    least = least_count(total, limit)
    owners = held.select("copy", F.explode("entities").alias("entity"))
    often = owners.groupBy("entity").agg(F.count("*").alias("n_e")).where((F.col("n_e") >= least) & (F.col("n_e") < total))
    often = staged(often, "often")
    none = documents.sparkSession.createDataFrame([], "copy binary, entity string, term string, bits double")
    most = often.agg(F.max("n_e")).head()[0]
    if most is None:
        return none.select("entity", "term", "bits"), none.select("copy", "term")
    # Only small rows meet by entity; a text's terms come by its copy, of which there is one.
    mine = owners.join(often, "entity", "left_semi").groupBy("copy").agg(F.collect_list("entity").alias("mine"))
    # At least the texts with any entity that have the term have it: an exact bound on certainty. It spares
    # common words the meeting with entities and the count over all texts.
    near = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_near"))
    near = staged(near.where((F.col("n_near") >= least) & (F.col("n_near") * certainty <= most)), "near")
    both = held.select("copy", F.explode("terms").alias("term")).join(near, "term").join(mine, "copy")
    pairs = both.select("term", "n_near", F.explode("mine").alias("entity")).groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.first("n_near").alias("n_near"))
    pairs = pairs.where((F.col("n_te") >= least) & (F.col("n_te") >= certainty * F.col("n_near"))).join(often, "entity")
    # A term that more texts have is less of a surprise, so what is usual already among these stays so.
    pairs = staged(pairs.where(surprise(F.col("n_te"), F.col("n_near"), F.col("n_e"), total) >= -limit).drop("n_near"), "pairs")
    terms = staged(pairs.select("term").distinct(), "terms")
    if not terms.head(1):
        return none.select("entity", "term", "bits"), none.select("copy", "term")
    split = F.array_distinct(F.split(F.lower(F.regexp_replace("text", r"[^\p{L}]+", " ")), " "))
    has = documents.select(copy_key().alias("copy"), F.explode(split).alias("term")).join(terms, "term", "left_semi").distinct()
    # In texts with entities a word inside a span is no term.
    own = held.select("copy", F.explode("terms").alias("term")).join(terms, "term", "left_semi")
    has = staged(has.join(owners.select("copy").distinct(), "copy", "left_anti").select("copy", "term").union(own.select("copy", "term")), "has")
    known = pairs.join(has.groupBy("term").agg(F.count("*").alias("n_t")), "term")
    counts = [F.col(c) for c in ("n_te", "n_t", "n_e")]
    telling = known.where((F.col("n_te") >= certainty * F.col("n_t")) & (surprise(*counts, total) >= -limit))
    bits = F.log2(F.col("n_te") / F.col("n_t") / (F.col("n_e") / F.lit(float(total))))
    return staged(telling.select("entity", "term", bits.alias("bits")), "telling"), has


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, telling in zip(batch.column(1).to_pylist(), map(set, batch.column(2).to_pylist()), strict=True):
            out.append([{"start": a, "kind": len(KINDS), "end": b} for w, a, b in words(text, base_spans(text)) if w in telling])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _SPANS)], names=["copy", "terms"])


def term_spans(documents: DataFrame, scanned: DataFrame) -> DataFrame:
    """copy, terms: the spans of telling terms in each text that has some."""
    telling, has = telling_terms(documents, scanned)
    marks = has.join(telling.select("term").distinct(), "term").groupBy("copy").agg(F.collect_set("term").alias("telling"))
    rows = _keyed(documents).join(marks, "copy").select("copy", "text", "telling")
    found = rows.mapInArrow(released(_marked), "copy binary, terms array<struct<start:int,kind:int,end:int>>")
    return staged(found.groupBy("copy").agg(F.first("terms").alias("terms")), "term-spans")


_NONE = "cast(array() as array<struct<start:int,kind:int,end:int>>)"


def find(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, base and terms (arrays of start, kind, end).

    Positions are code points, ends exclusive. A null or empty text has no spans. Repeated rows
    have the same spans; a null doc_id stays null; an empty table gives no rows; other columns are ignored.
    """
    scanned = scan(documents)
    terms = term_spans(documents, scanned)
    return scanned.select("doc_id", "copy", "base").join(terms, "copy", "left").select("doc_id", "base", F.coalesce("terms", F.expr(_NONE)).alias("terms"))


def summary(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of base spans and all spans as text."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    line = lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), line), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "terms")).alias("spans")
    )


_TAGS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]")


def clean_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by its first span's tag."""
    out, at, k = [], 0, 0
    spans = sorted(spans)
    while k < len(spans):
        start, kind, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], _TAGS[kind]]
        at = end
    return "".join(out) + text[at:] if out else text


def sanitize(documents: DataFrame) -> DataFrame:
    """``documents`` with personal data in ``text`` replaced by tags until no pattern matches; all columns stay.

    Null texts stay null. Other columns keep their values, whatever their names.
    """
    scanned = scan(documents)
    terms = term_spans(documents, scanned)
    columns, schema = documents.columns, documents.schema
    place = columns.index("text")
    key, extra = "_copy_of_text", "_terms_of_text"
    joined = documents.withColumn(key, copy_key()).join(terms.select(F.col("copy").alias(key), F.col("terms").alias(extra)), key, "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in columns], extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, more in zip(batch.column(place).to_pylist(), batch.column(len(columns)).to_pylist(), strict=True):
                if text:
                    text = clean_text(text, base_spans(text) + [(s["start"], s["kind"], s["end"]) for s in more or ()])
                    while spans := base_spans(text):  # what stood apart before may meet now
                        text = clean_text(text, spans)
                out.append(text)
            arrays = [pa.array(out, batch.column(place).type) if k == place else batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return joined.mapInArrow(released(run), schema)
