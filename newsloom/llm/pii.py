"""Personal data: what patterns find, and the terms that give it away."""

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import store, unused_names

# Order of kinds where spans start alike; the last is what the corpus adds.
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The classes on both sides of each possessive part differ, so that it loses no match and every
# search is linear in the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W_]{3,}")

# Words on each side of a protected entity that are counted as met with it.
WINDOW = 8
# Different texts in which term and entity must meet before they say anything.
MIN_TEXTS = 3
# Share of an entity's information from which a term that discloses it is made general or removed.
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
# Of the texts that hold a term, the share that hold it near the entity, from which it can disclose
# that entity. Without it the bound would fall as the corpus grows: a rare entity has much
# information, of which a word of hundreds of texts holds most.
MIN_GIVEN = 0.5
# Terms that a task counts before it hands its counts on.
_HELD_TERMS = 300_000
# Marks, by hash, of the terms that disclose; a task looks up the words of its texts in them.
_MARKS = 1 << 22
_KNOWN_WORDS = 200_000

Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[Span]:
    """An address ends its local part at an @, so that only these are looked at."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, 0, found.end()
            floor = found.end()
        at = text.find("@", found.end() if found else at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, place of the kind in KINDS, end) in code points, in that order."""
    spans = list(_emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _entity(text: str, span: Span) -> str:
    start, kind, end = span
    value = text[start:end]
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else _NOT_DIGITS.sub('', value)}"


def free_words(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """(start, end) of the words that are part of no span."""
    words, at = [], 0
    for m in _WORD.finditer(text):
        while at < len(spans) and spans[at][2] <= m.start():
            at += 1
        if not any(s < m.end() and m.start() < e for s, _, e in spans[at : at + len(KINDS)]):
            words.append((m.start(), m.end()))
    return words


def contexts(text: str, spans: list[Span], window: int = WINDOW) -> set[tuple[str, str]]:
    """(entity, term) of the words around each span that are part of none."""
    words = free_words(text, spans)
    found = set()
    for span in spans:
        entity, place = _entity(text, span), bisect_left(words, (span[0], 0))
        for start, end in words[max(0, place - window) : place + window]:
            found.add((entity, text[start:end].lower()))
    return found


_SPANS = "array<struct<start: int, kind: int, end: int>>"
_FOUND = (
    f"term string, n bigint, doc_id bigint, digest string, spans {_SPANS}, "
    "near array<struct<entity: string, term: string>>"
)


def _find(documents: DataFrame, window: int) -> DataFrame:
    """Two kinds of rows from one reading: per document its digest, base spans and the terms
    near them, each once (term null), and how many documents of a task hold a term (term not null)."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))

    def rows(terms, n, ids, digests, spans, near) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(terms, pa.string()), pa.array(n, pa.int64()), pa.array(ids, pa.int64()),
                pa.array(digests, pa.string()), pa.array(spans, spans_type), pa.array(near, near_type),
            ],
            ["term", "n", "doc_id", "digest", "spans", "near"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            items = list(held.items())
            held.clear()
            for i in range(0, len(items), 50_000):
                part = items[i : i + 50_000]
                none = [None] * len(part)
                yield rows([t for t, _ in part], [n for _, n in part], none, none, none, none)

        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            all_spans, all_near = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                all_spans.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans])
                near = contexts(text, spans, window) if spans else ()
                all_near.append([{"entity": e, "term": t} for e, t in sorted(near)])
                held.update(set(_WORD.findall(text.lower())))
                if len(held) > _HELD_TERMS:
                    yield from counted()
            none = [None] * len(ids)
            yield rows(none, none, ids, digests, all_spans, all_near)
        yield from counted()

    return documents.mapInArrow(run, _FOUND)


def _strong(found: DataFrame, min_texts: int, generalise_at: float, min_given: float) -> DataFrame:
    """(term, share) of the terms that disclose an entity, with the greatest of their shares.

    share is the pointwise mutual information of term and entity, log2 P(e|t) / P(e), over the
    information of the entity, -log2 P(e): 1 where the term occurs only near that entity.
    """
    docs = found.where("term IS NULL")
    total = docs.count()
    near = docs.where("size(near) > 0").select("digest", F.explode("near").alias("x")).select("digest", "x.*")
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.countDistinct("digest").alias("texts"))
    pairs = store(pairs.where(F.col("texts") >= min_texts), "pairs")
    entities = docs.where("size(near) > 0").select(F.explode(F.array_distinct(F.expr("transform(near, x -> x.entity)"))).alias("entity"))
    n_entity = entities.join(pairs.select("entity").distinct(), "entity").groupBy("entity").agg(F.count("*").alias("n_entity"))
    wanted = store(pairs.select("term").distinct(), "terms")
    # Most terms never meet an entity; these go before the counts are exchanged.
    n_term = found.where("term IS NOT NULL").join(wanted, "term").groupBy("term").agg(F.sum("n").alias("n_term"))
    share = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity"))) / F.log2(
        F.lit(float(total)) / F.col("n_entity")
    )
    # An entity of all documents has no information to disclose.
    strong = pairs.join(n_entity, "entity").join(n_term, "term").where(F.col("n_entity") < total)
    given = F.col("n_both") / F.col("n_term")
    strong = strong.where(given >= min_given).select("term", share.alias("share")).where(F.col("share") >= generalise_at)
    return store(strong.groupBy("term").agg(F.max("share").alias("share")), "strong")


_PLACES = "digest string, term string, start int, end int"


def _places(documents: DataFrame, marks: np.ndarray) -> DataFrame:
    """Where the texts hold words whose hash is in `marks`, other than in base spans."""
    shared = documents.sparkSession.sparkContext.broadcast(marks)  # _MARKS bytes, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, known = shared.value, {}

        def marked(word: str) -> bool:
            found = known.get(word)
            if found is None:
                found = bool(marks[zlib.crc32(word.lower().encode()) % _MARKS])
                if len(known) < _KNOWN_WORDS:
                    known[word] = found
            return found

        for batch in batches:
            out = []
            for digest, value in zip(batch.column(1).to_pylist(), batch.column(0), strict=True):
                text = value.as_py() or ""
                some = {w for w in set(_WORD.findall(text)) if marked(w)}
                if some:
                    for start, end in free_words(text, base_spans(text)):
                        if text[start:end] in some:
                            out.append((digest, text[start:end].lower(), start, end))
            digests, terms, starts, ends = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.string()), pa.array(terms, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                ["digest", "term", "start", "end"],
            )

    return documents.select("text", "digest").mapInArrow(run, _PLACES)


def _flagged(documents: DataFrame, strong: DataFrame) -> DataFrame:
    """(digest, terms: array<struct<start, kind, end, share>>) of texts with terms that disclose,
    at all places, near an entity or not."""
    marks = np.zeros(_MARKS, bool)
    marks[strong.select((F.crc32(F.col("term").cast("binary")) % _MARKS).alias("mark")).distinct().toArrow().column(0).to_numpy()] = True
    # Without marks no text is read again.
    again = documents if marks.any() else documents.limit(0)
    # Other terms may share a mark; the join leaves these out.
    one = _places(again, marks).distinct().join(strong, "term")
    span = F.struct(F.col("start"), F.lit(len(KINDS) - 1).alias("kind"), F.col("end"), F.col("share"))
    return store(one.groupBy("digest").agg(F.sort_array(F.collect_list(span)).alias("terms")), "flagged")


def _with_digest(documents: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select("*", F.sha2(body, 256).alias("digest"))


def _analyse(documents, text, doc_id, window, min_texts, generalise_at, min_given) -> tuple[DataFrame, DataFrame]:
    slim = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    slim = _with_digest(slim, "text")
    found = store(_find(slim, window), "found")
    return found.where("term IS NULL"), _flagged(slim, _strong(found, min_texts, generalise_at, min_given))


def find_personal_data(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    min_texts: int = MIN_TEXTS,
    generalise_at: float = GENERALISE_AT,
    min_given: float = MIN_GIVEN,
) -> DataFrame:
    """(doc_id, spans: array<struct<start, kind, end>>) of every row, spans in order; kind is
    the place in KINDS, start and end count code points.

    Base spans come from patterns. Corpus co-occurrence adds terms: words within `window`
    words of a protected entity in at least `min_texts` different texts, that disclose at
    least the share `generalise_at` of its information, and stand near it in `min_given` of the texts
    that hold them. The window is for the estimate only:
    such a term is a span wherever it stands outside base spans, in every document. Documents count with their copies in
    all probabilities, but copies are one text. A null text is empty and has no spans; a row
    comes out as often as it comes in; no rows give no rows.
    """
    docs, flagged = _analyse(documents, text, doc_id, window, min_texts, generalise_at, min_given)
    terms = F.expr("transform(terms, x -> struct(x.start as start, x.kind as kind, x.end as end))")
    both = F.sort_array(F.concat("spans", F.coalesce(terms, F.expr(f"cast(array() as {_SPANS})"))))
    return docs.select("doc_id", "digest", "spans").join(flagged, "digest", "left").select("doc_id", both.alias("spans"))


def _cleaned(text: str, terms: list[dict], remove_at: float) -> str:
    """The text with base spans as tags, terms as a general word or removed."""
    cuts = [(s, e, f"[{KINDS[k].upper()}]") for s, k, e in base_spans(text)]
    cuts += [(t["start"], t["end"], "" if t["share"] >= remove_at else "[TERM]") for t in terms]
    parts, at = [], 0
    for start, end, tag in sorted(cuts):
        if start >= at:
            parts += [text[at:start], tag]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitise(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    min_texts: int = MIN_TEXTS,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
    min_given: float = MIN_GIVEN,
) -> DataFrame:
    """All rows and columns, with the spans of `find_personal_data` taken out of `text`.

    A base span becomes the name of its kind in brackets; a term becomes [TERM], or nothing
    from `remove_at` on. Of spans that overlap the first decides. Null stays null.
    """
    _, flagged = _analyse(documents, text, doc_id, window, min_texts, generalise_at, min_given)
    key, terms, found_key = unused_names(documents, "digest", "terms", "found_digest")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = documents.withColumn(key, F.sha2(body, 256)).join(
        flagged.select(F.col("digest").alias(found_key), F.col("terms").alias(terms)),
        F.col(key) == F.col(found_key),
        "left",
    ).select(*documents.columns, terms)
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            found = columns.pop().to_pylist()
            texts = columns[at].to_pylist()
            clean = [None if t is None else _cleaned(t, f or [], remove_at) for t, f in zip(texts, found, strict=True)]
            columns[at] = pa.array(clean, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return marked.mapInArrow(run, documents.schema)
