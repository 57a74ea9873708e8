"""Personal data: fixed kinds, and terms that reveal them.

Spans of four kinds are found first: email, ip, card, phone.  A span's kind and text, in lower case, are a protected entity.  All
words of the documents that hold an entity, outside spans, are its terms.  Over all documents, with p as shares of documents,
a term t discloses an entity e by PMI(t; e) / IC(e) = ln(p(t, e) / (p(t) p(e))) / -ln p(e): 1 if t occurs only with
e, 0 if they are independent.  Pairs with at least ``SUPPORT`` different surroundings count, so that copies of one
passage are no evidence: surroundings are the words within ``REACH`` words of a span of e, each that holds t, or the least one
of the document if t stands further away.  A term at or above ``GENERALISE`` for an entity becomes a placeholder (span kind
term) and one at or above ``REMOVE`` goes (span kind removed), wherever it stands outside spans: also far from the entity,
and in documents without it, which it would reveal.  Pairs are counted with partial sums in each task; fixed-size bit
tables only keep entities and terms that are not in question out of the shuffle.

Places are code points, ends exclusive.  Null counts as empty, and empty texts have no spans.  Every row gives one
row, also where keys repeat or rows are equal.  An empty table gives no rows.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadstream.llm.texts import Words, keyed_texts, mix, small_batches, split_rows, text_of
from roadstream.shared import freeze

KINDS = ("email", "ip", "card", "phone", "term", "removed")
REACH = 8
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
SLOTS = 1 << 20
MARKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>", "removed": ""}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_DIGIT = re.compile("[0-9]").search


def _emails(text: str):
    after, at = 0, text.find("@")
    while at >= 0:
        before = text[after:at]
        start = after + len(before.rstrip(_LOCAL))
        found = _DOMAIN(text, at + 1) if start < at else None
        after = found.end() if found else at + 1
        if found:
            yield start, found.end()
        at = text.find("@", after)


def _addresses(text: str):
    for chain in _DOTTED(text):
        parts = chain[0].split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2]))
    return (total + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def _cards(text: str):
    for found in _CARD(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            yield found.span()


def _phones(text: str):
    for found in _PHONE(text):
        if 10 <= sum(x.isdigit() for x in found[0]) <= 15:
            yield found.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four kinds, by start and kind."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT(text):
        spans += [(a, 1, b) for a, b in _addresses(text)]
        spans += [(a, 2, b) for a, b in _cards(text)]
        if "+" in text:
            spans += [(a, 3, b) for a, b in _phones(text)]
    return sorted(spans)


def _hash_texts(texts: list[str]) -> np.ndarray:
    """64-bit hashes of whole strings."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(x) for x in texts], dtype=np.uint64).view(np.int64)


def _free(words: Words, place: int, base: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, term) of the words of text ``place`` outside its spans."""
    low, high = np.searchsorted(words.doc, [place, place + 1])
    start, end = words.start[low:high] - words.first[place], words.end[low:high] - words.first[place]
    free = np.ones(high - low, dtype=bool)
    for a, _, b in base:
        free[np.searchsorted(end, a, "right"):np.searchsorted(start, b, "left")] = False
    return start[free], end[free], words.hash[low:high][free].view(np.int64)


def _surroundings(text: str, base: list[tuple[int, int, int]], free: tuple[np.ndarray, ...]) -> list[tuple[int, int, np.ndarray]]:
    """(entity, around, terms near it) of each span."""
    start, end, term = free
    entity = _hash_texts([f"{kind}:{text[a:b].lower()}" for a, kind, b in base]).tolist()
    found = []
    for (a, _, b), name in zip(base, entity):
        first = max(0, int(np.searchsorted(end, a, "right")) - REACH)
        body = term[first:int(np.searchsorted(start, b, "left")) + REACH]
        around = int(mix(np.cumsum(body.view(np.uint64) * np.uint64(3))).sum().view(np.int64)) if len(body) else 0
        found.append((name, around, body))
    return found


def find(rows: DataFrame) -> DataFrame:
    """Per row: doc_id, digest of the text, base (array of start, kind, end), held (different entity and around)."""
    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch):
                base = [base_spans(x) for x in texts]
                held = [[] for _ in texts]
                some = [k for k, x in enumerate(base) if x]
                words = Words([texts[k] for k in some])
                for place, k in enumerate(some):
                    held[k] = sorted({x[:2] for x in _surroundings(texts[k], base[k], _free(words, place, base[k]))})
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([[dict(zip(("start", "kind", "end"), y)) for y in x] for x in base], _BASE),
                     pa.array([[dict(zip(("entity", "around"), y)) for y in x] for x in held], _HELD)],
                    ["doc_id", "digest", "base", "held"])

    return rows.withColumn("digest", F.sha2("text", 256)).mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest string, base array<struct<start:int,kind:int,end:int>>, "
        "held array<struct<entity:long,around:long>>")


_BASE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_HELD = pa.list_(pa.struct([("entity", pa.int64()), ("around", pa.int64())]))


def _bits(values: DataFrame, name: str) -> np.ndarray:
    """Packed bits of the slots that ``values`` use."""
    table = np.zeros(SLOTS, dtype=bool)
    table[values.select(F.pmod(name, F.lit(SLOTS)).alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)] = True
    return np.packbits(table)


def _together(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, term, both, support): documents with both and different surroundings, up to ``SUPPORT`` from each partial sum."""
    sent = rows.sparkSession.sparkContext.broadcast(_bits(entities, "entity"))

    def run(batches):
        mask = np.unpackbits(sent.value).view(bool)
        kept, size = [], 0
        for batch in batches:
            for _, texts in split_rows(batch):
                base = [base_spans(x) for x in texts]
                some = [k for k, x in enumerate(base) if x]
                words = Words([texts[k] for k in some])
                for place, k in enumerate(some):
                    free = _free(words, place, base[k])
                    near = [x for x in _surroundings(texts[k], base[k], free) if mask[x[0] % SLOTS]]
                    terms = np.unique(free[2])
                    for entity in {x[0] for x in near}:
                        around = [(x[1], np.unique(x[2])) for x in near if x[0] == entity]
                        far = np.setdiff1d(terms, np.concatenate([x[1] for x in around]))
                        around.append((min(x[0] for x in around), far))
                        term = np.concatenate([x[1] for x in around])
                        table = np.stack([np.full(len(term), entity), term, np.repeat([x[0] for x in around], [len(x[1]) for x in around]),
                                          np.zeros(len(term), np.int64)])
                        table = table[:, np.lexsort(table[1:2])]
                        table[3] = np.diff(table[1], prepend=table[1, :1] - 1) != 0  # each document counts once
                        kept.append(table)
                        size += len(term)
                    if size > 1 << 20:
                        yield partial(kept)
                        kept, size = [], 0
        yield partial(kept)

    def partial(kept):
        table = np.concatenate([np.empty((4, 0), np.int64), *kept], axis=1)
        table = table[:, np.lexsort(table[2::-1])]
        entity, term, around, n = table
        pair = np.diff(entity, prepend=0) != 0
        pair |= np.diff(term, prepend=0) != 0
        pair[:1] = True
        item = pair | (np.diff(around, prepend=0) != 0)
        first, place = np.flatnonzero(pair), np.cumsum(pair) - 1
        both = np.zeros(len(entity), np.int64)
        if len(first):
            both[first] = np.add.reduceat(n, first)
            rank = np.cumsum(item) - np.cumsum(item)[first][place]
            item &= rank < SUPPORT
        return pa.RecordBatch.from_arrays([pa.array(x[item]) for x in (entity, term, around, both)], ["entity", "term", "around", "n"])

    parts = rows.select("text").mapInArrow(run, "entity long, term long, around long, n long")
    return parts.groupBy("entity", "term").agg(F.sum("n").alias("both"), F.count_distinct("around").alias("support"))


def _places(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(digest, term, start, end): where texts hold ``terms``, and whatever shares their slots, outside spans."""
    sent = rows.sparkSession.sparkContext.broadcast(_bits(terms, "term"))

    def run(batches):
        mask = np.unpackbits(sent.value).view(bool)
        for batch in batches:
            for part, texts in split_rows(batch):
                words = Words(texts)
                here = np.unique(words.doc[mask[words.hash.view(np.int64) % SLOTS]])
                for k in here.tolist():
                    start, end, term = _free(words, k, base_spans(texts[k]))
                    use = mask[term % SLOTS]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1).take(pa.array(np.full(int(use.sum()), k))), pa.array(term[use]), pa.array(start[use].astype(np.int32)),
                         pa.array(end[use].astype(np.int32))], ["digest", "term", "start", "end"])

    texts = rows.select("text", F.sha2("text", 256).alias("digest"))
    return texts.mapInArrow(run, "digest string, term long, start int, `end` int")


def _document_frequencies(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df) over all texts, for ``terms`` and whatever shares their slots."""
    sent = rows.sparkSession.sparkContext.broadcast(_bits(terms, "term"))

    def count(batches):
        mask = np.unpackbits(sent.value).view(bool)
        kept, size = [], 0
        for batch in batches:
            for _, texts in split_rows(batch):
                words = Words(texts)
                here = mask[(words.hash.view(np.int64) % SLOTS)]
                doc, word = words.doc[here], words.hash[here]
                order = np.lexsort([word, doc])
                doc, word = doc[order], word[order]
                kept.append(word[(np.diff(doc, prepend=-1) != 0) | (np.diff(word, prepend=np.uint64(0)) != 0)])
                size += len(kept[-1])
                if size > 1 << 21:
                    yield partial(kept)
                    kept, size = [], 0
        yield partial(kept)

    def partial(kept):
        found, n = np.unique(np.concatenate([np.empty(0, np.uint64), *kept]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["term", "n"])

    return rows.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


def disclosure(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(entity, term, kind): the terms that disclose an entity, and whether each is generalised or removed."""
    held = found.select(F.explode("held").alias("x")).select("x.entity", "x.around")
    # No pair has more surroundings than its entity.
    entities = held.groupBy("entity").agg(F.count_distinct("around").alias("n")).filter(F.col("n") >= SUPPORT)
    together = freeze(_together(rows, entities).filter(F.col("support") >= SUPPORT), "together")
    holders = found.select(F.explode(F.array_distinct("held.entity")).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("holders"))
    total = found.count()
    measured = together.join(holders.hint("merge"), "entity").join(_document_frequencies(rows, together).hint("merge"), "term")
    content = -F.log(F.col("holders") / total)
    shared = F.log(F.col("both") * F.lit(float(total)) / (F.col("df") * F.col("holders")))
    ratio = F.when(content > 0, shared / content)
    return measured.select("entity", "term", F.when(ratio >= REMOVE, KINDS.index("removed")).when(
        ratio >= GENERALISE, KINDS.index("term")).alias("kind")).filter("kind is not null")


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, base, spans): arrays of (start, kind, end), by start and kind; kind is a place in ``KINDS``."""
    rows = keyed_texts(docs, key, text)
    found = freeze(find(rows).withColumn("row", F.monotonically_increasing_id()), "found")
    rules = freeze(disclosure(found, rows), "rules")
    terms = freeze(rules.groupBy("term").agg(F.max("kind").alias("kind")), "terms")
    added = _places(rows, terms).join(terms.hint("merge"), "term").select("digest", "start", "end", "kind").distinct()
    added = added.groupBy("digest").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return found.join(added, "digest", "left").select("row", "doc_id", "base", every.alias("spans"))


def written(places: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(places, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def count(places: Column, kind: str) -> Column:
    return F.size(F.filter(places, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def replace(text: str, places: list[dict]) -> str:
    """``text`` with marks for its spans; spans that overlap share the first one's mark."""
    out, at = [], 0
    for place in places:
        if place["start"] >= at:
            out += [text[at:place["start"]], MARKS[KINDS[place["kind"]]]]
        at = max(at, place["end"])
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with marks in place of personal data and of terms that disclose it."""
    small_batches(docs.sparkSession)
    stamped = docs.select(docs[key], text_of(docs, text).alias("text"))
    numbered = stamped.select(F.struct(docs[key].alias("key"), F.sha2("text", 256).alias("digest")).alias("doc_id"), "text")
    marked = spans(numbered, "doc_id", "text").filter(F.size("spans") > 0).groupBy("doc_id").agg(F.max("spans").alias("_spans"))
    marked = marked.select(F.col("doc_id.key").alias("_key"), F.col("doc_id.digest").alias("_digest"), "_spans")
    body = text_of(docs, text)
    joined = docs.join(marked.hint("merge"), docs[key].eqNullSafe(F.col("_key")) & (F.sha2(body, 256) == F.col("_digest")), "left")
    names, place = docs.columns, docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for part, texts in split_rows(batch, text):
                marks = part.column(len(names)).to_pylist()
                new = [replace(x, y) if y else x for x, y in zip(texts, marks)]
                columns = part.columns[: len(names)]
                columns[place] = pa.array(new, batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*(docs[x] for x in docs.columns), "_spans").mapInArrow(run, docs.schema)
