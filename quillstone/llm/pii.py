"""Personal data: patterns, and information-theoretic sanitisation of the terms around them.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers; each distinct value is
a protected entity.  A term near an entity may give it away: with document counts over the whole
corpus, the information that term t gives of entity c is their pointwise mutual information, at most
the entity's own information,

    PMI(c; t) = log(N * n(c, t) / (n(c) * n(t))),   IC(c) = log(N / n(c)),

where n(c, t) counts documents in which t stands near c: among the WINDOW long and the WINDOW short
terms on either side of a mention, across line ends.  Terms whose share PMI / IC reaches GENERALISE_AT
are generalised, from REMOVE_AT on removed, wherever they stand in a document that holds c.  Every pair is scored, also
one seen in a single document, as most entities stand in no more: a term that stands nowhere else leads
to its entity, whether by chance or not.

Terms are runs of letters and digits, compared without the case of A-Z.  A long one has LONG
characters or more; a shorter one of two or three counts as near an entity only if it holds a capital, a
digit or a character beyond ASCII, as names and codes do ("Ann", "b7"), so that "at" or "the" is no term.
A short name in small letters is found where it stands in capitals near the entity too.  Single
characters are no terms.

All terms of the corpus are counted before they are joined with those near an entity, so that the join
takes one row of each.

Defined results: null text counts as empty; failing matches of a pattern are dropped without retry;
very long texts are searched whole, in linear work; repeated rows count as documents of their own; an entity that all documents hold
has no information and no terms; of two entities that give a term different shares in a document the larger
share counts; null identifiers stay null; without entities there are no terms; in an empty corpus the
result is empty; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bounded, cut, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# The patterns of the four kinds, in forms that look at a character a bounded number of times.  A
# mailbox name is taken with or without what follows it, as nothing inside it could start a match where its start
# can't; a match that starts with digits starts where they do, as no match ends before more digits.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A term: two or more letters and digits, where all but ASCII counts as letters.
TERM = re.compile("[A-Za-z0-9\u0080-\U0010ffff]{2,}")
NOT_TERM_SQL = r"[^A-Za-z0-9\x{80}-\x{10FFFF}]+"
#: What a term of fewer than LONG characters has if it counts.
MARKED = re.compile("[A-Z0-9\u0080-\U0010ffff]")
DIGITS = re.compile("[0-9]")
LONG = 4
WINDOW = 8
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
LOWER = {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start, end (code points, end exclusive), by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", m.start(), m.end()) for m in EMAIL.finditer(text) if m.group(1)]
    if not DIGITS.search(text):
        return out
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _entity(kind: str, value: str) -> str:
    value = value.translate(LOWER) if kind in ("email", "ip") else re.sub("[^0-9]", "", value)
    return f"{kind}:{value}"


def _free_terms(text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match]:
    """The terms that don't overlap a mention, in order."""
    covered = sorted((a, b) for _, a, b in spans)
    k, reach = 0, 0
    for m in TERM.finditer(text):
        while k < len(covered) and covered[k][0] < m.end():
            reach = max(reach, covered[k][1])
            k += 1
        if reach <= m.start():
            yield m


def _near(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str]]:
    """entity, term of the terms near a mention; those that overlap a mention don't count."""
    if not spans:
        return []
    sorts: list[tuple[list[int], list[str]]] = [([], []), ([], [])]
    for m in _free_terms(text, spans):
        term = m.group()
        if len(term) >= LONG or MARKED.search(term):
            starts, terms = sorts[len(term) >= LONG]
            starts.append(m.start())
            terms.append(term.translate(LOWER))
    found = set()
    for kind, a, b in spans:
        entity = _entity(kind, text[a:b])
        for starts, terms in sorts:
            k = bisect_left(starts, a)
            found.update((entity, term) for term in terms[max(0, k - WINDOW) : k + WINDOW])
    return sorted(found)


def _spans(joined: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in joined.split(",") if x)]


def _join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _detect(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                counts, joined, near, entities, held = {k: [] for k in KINDS}, [], [], [], []
                for text in part.column("text").to_pylist():
                    spans = base_spans(text)
                    for k in KINDS:
                        counts[k].append(sum(s[0] == k for s in spans))
                    joined.append(_join_spans(spans))
                    near.append([dict(zip(("entity", "term"), x)) for x in _near(text, spans)])
                    held.append(text if spans else None)
                    entities.append(sorted({_entity(k, text[a:e]) for k, a, e in spans}))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(joined, pa.string()), pa.array(entities, pa.list_(pa.string())), pa.array(near, near_type), pa.array(held, pa.string())],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base", "entities", "near", "held"],
                )

    return slim.mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, entities array<string>, near array<struct<entity:string,term:string>>, held string")


def _words(text: Column) -> Column:
    """The distinct terms of text, and what single characters and "" stand between them."""
    return F.array_distinct(F.split(ascii_lower(text), NOT_TERM_SQL))


def _place(rows: DataFrame) -> DataFrame:
    """rows' of_row, and terms as spans wherever they stand in held outside the mentions; rows: of_row, base, held, given (term, disclosed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("disclosed", pa.float64())]))
        for b in batches:
            for i in range(0, b.num_rows, 100):
                part, out = b.slice(i, 100), []
                for base, text, given in zip(*(part.column(c).to_pylist() for c in ("base", "held", "given"))):
                    share = {x["term"]: x["disclosed"] for x in given}
                    placed = ((m.start(), m.end(), share.get(m.group().translate(LOWER))) for m in _free_terms(text, _spans(base)))
                    out.append([{"start": a, "end": e, "disclosed": d} for a, e, d in placed if d is not None])
                yield pa.RecordBatch.from_arrays([part.column("of_row"), pa.array(out, kind)], ["of_row", "placed"])

    return rows.select("of_row", "base", "held", "given").mapInArrow(run, "of_row bigint, placed array<struct<start:int,end:int,disclosed:double>>")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base (spans), terms (kind, start, end, disclosed) for every row of docs."""
    found = cut(_detect(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    total = found.count()
    near = found.where(F.size("near") > 0).select(F.explode("near").alias("x")).select("x.*")
    pairs = cut(near.groupBy("entity", "term").agg(F.count("*").alias("both")))  # near holds a pair once for each row
    of_entity = cut(found.select(F.explode("entities").alias("of")).groupBy("of").agg(F.count("*").alias("n_entity")))
    counted = docs.select(F.explode(_words(text_or_empty(text_col))).alias("of_term")).groupBy("of_term").agg(F.count("*").alias("n_term"))
    of_term = cut(counted.join(pairs.select(F.col("term").alias("of_term")).distinct(), "of_term", "left_semi"))
    scored = pairs.join(bounded(of_entity), F.col("entity") == F.col("of")).join(bounded(of_term), F.col("term") == F.col("of_term"))
    information = F.log(F.lit(float(max(total, 1))) / F.col("n_entity"))
    mutual = F.log(F.lit(float(max(total, 1))) * F.col("both") / (F.col("n_entity") * F.col("n_term")))
    share = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    disclosing = cut(scored.select(F.col("entity").alias("of_entity"), F.col("term").alias("of_term"), share.alias("disclosed")).where(F.col("disclosed") >= generalise_at))
    # Joined by term before entity: a term gives few entities away, an entity may be given away by a term in each of its documents.
    private = found.where(F.col("held").isNotNull())
    words = private.select(F.col("row").alias("of_row"), F.explode(_words(F.col("held"))).alias("word"))
    mentions = private.select(F.col("row").alias("in_row"), F.explode("entities").alias("in_entity"))
    hits = words.join(bounded(disclosing), F.col("word") == F.col("of_term")).join(mentions, (F.col("of_row") == F.col("in_row")) & (F.col("of_entity") == F.col("in_entity")), "left_semi")
    given = hits.groupBy("of_row", "of_term").agg(F.max("disclosed").alias("disclosed"))
    given = cut(given.groupBy("of_row").agg(F.collect_list(F.struct(F.col("of_term").alias("term"), "disclosed")).alias("given")))  # one document's terms
    placed = _place(private.join(given, F.col("row") == F.col("of_row")))
    kind = lambda x: F.when(x["disclosed"] >= remove_at, "remove").otherwise("generalise")
    spans = placed.select("of_row", F.transform("placed", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), kind(x).alias("action"), x["disclosed"].alias("disclosed"))).alias("terms"))
    return found.join(spans, F.col("row") == F.col("of_row"), "left").select("doc_id", *[f"n_{k}" for k in KINDS], "base", F.coalesce("terms", F.expr("cast(array() as array<struct<start:int,end:int,action:string,disclosed:double>>)")).alias("terms"))


def report(found: DataFrame) -> DataFrame:
    """The digest columns from find()'s result."""
    terms = F.transform(F.sort_array(F.transform("terms", lambda t: F.struct(t["action"].alias("a"), t["start"].alias("s"), t["end"].alias("e")))), lambda t: F.concat_ws(":", t["a"], t["s"].cast("string"), t["e"].cast("string")))
    extra = F.array_join(terms, ",")
    spans = F.when(extra == "", F.col("base")).when(F.col("base") == "", extra).otherwise(F.concat_ws(",", "base", extra))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """text with its spans ("kind:start:end", comma-joined) replaced: base kinds by their name, generalised terms by [TERM], removed ones by nothing."""

    @F.pandas_udf("string")
    def run(texts, joined):
        out = []
        for t, s in zip(texts, joined):
            t = t or ""
            parts = sorted(((int(a), int(b), k) for k, a, b in (x.split(":") for x in (s or "").split(",") if x)))
            done, at = [], 0
            for a, b, k in parts:
                if a >= at:
                    done += [t[at:a], "" if k == "remove" else "[TERM]" if k == "generalise" else f"[{k.upper()}]"]
                    at = b
            out.append("".join([*done, t[at:]]))
        return type(texts)(out)

    return run(text, spans)
