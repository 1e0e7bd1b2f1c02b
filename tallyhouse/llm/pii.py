"""Personal data by patterns with checks, and by bootstrapped contextual extraction.

Emails, addresses, card and phone numbers are found by form. These seed the bootstrap: the
words before an entity are its lexical context, and every token that could be an identifier
(it has a digit or an at sign) is an instance in its context. Spark scores the graph of
contexts and instances in turn: a context is as good as its instances are known, an
instance as good as the contexts that were confident before. Confident contexts then mark
instances that no form covers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, forget, id_text, ship, slices, spans_text

KINDS = ("email", "ip", "card", "phone")  # base kinds in the order of results
FOUND = "id"  # kind of the spans that contexts add

EMAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]+\Z")
EMAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IN_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is one start: from inside it nothing can match that its start does not.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HAS_DIGIT = re.compile(r"[0-9@]")
# A run of token characters is one start here too.
TOKEN = re.compile(r"(?<![\w/.@+-])[^\W0-9]*+(?:[/.+-]++[^\W0-9]*+)*+[0-9@][\w/.@+-]*+")
AROUND = "/._+-"
WORD = re.compile(r"[^\W\d_]+|[:=#]")
LINE = "\n"


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local@domain.domain, leftmost first. Each at sign is looked at once, with
    the run of local characters before it that no earlier match has taken."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in IN_LOCAL:
            start -= 1
        if start < at and (m := EMAIL_RIGHT.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start; matches that fail a check are dropped."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not HAS_DIGIT.search(text):
        return out
    out += [(1, *m.span()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text)
            if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def words_before(text: str, starts: list[int], n: int = 2) -> Iterator[str]:
    """The last n words on the line before each of the ascending positions, in lower case. A
    line starts with as many line ends, so that there are always n. Looks at no character
    twice."""
    done, words = 0, [LINE] * n
    for start in starts:
        gap = text[done:start]
        if LINE in gap:
            gap, words = gap.rpartition(LINE)[2], [LINE] * n
        words = (words + WORD.findall(gap.lower()))[-n:]
        done = start
        yield " ".join(words)


def form_of(token: str) -> str:
    """The token in lower case; a hash of what is longer than 64 characters."""
    form = token.lower()
    return form if len(form) <= 64 else hashlib.sha256(form.encode()).hexdigest()


def scan_text(text: str) -> tuple[list, list]:
    """(base spans, instances); an instance is (context, form, known, start, end)."""
    base = base_spans(text)
    if not HAS_DIGIT.search(text):
        return base, []
    taken = sorted((a, b) for _, a, b in base)
    found = [(a, b, True) for a, b in taken]
    k = 0
    for a, b in iter_tokens(text):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b:
            continue  # part of a known entity
        found.append((a, b, False))
    found.sort()
    return base, [(context, form_of(text[a:b]), known, a, b) for (a, b, known), context
                  in zip(found, words_before(text, [a for a, _, _ in found]))]


def iter_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the tokens with a digit or an at sign, without the punctuation around them."""
    for m in TOKEN.finditer(text):
        a, b = m.span()
        token = m[0].rstrip(AROUND)
        b = a + len(token)
        yield b - len(token.lstrip(AROUND)), b


SPAN = "array<struct<kind:int,start:int,end:int>>"
INSTANCE = "array<struct<context:string,form:string,known:boolean,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_INSTANCES = pa.list_(pa.struct([("context", pa.string()), ("form", pa.string()),
                                 ("known", pa.bool_()), ("start", pa.int32()),
                                 ("end", pa.int32())]))


def text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, instances, row); `row` tells repeated doc_ids apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches):
            found = [scan_text(t) for t in batch.column("text").to_pylist()]
            base = [[dict(zip(("kind", "start", "end"), s)) for s in b] for b, _ in found]
            inst = [[dict(zip(("context", "form", "known", "start", "end"), s)) for s in i]
                    for _, i in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(base, _SPANS),
                 pa.array(inst, _INSTANCES)], ["doc_id", "text_hash", "base", "instances"])

    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = id_text(docs).withColumn("text_hash", text_hash()).mapInArrow(
        run, f"doc_id {id_type}, text_hash long, base {SPAN}, instances {INSTANCE}")
    return rows.withColumn("row", F.monotonically_increasing_id())


def confident_contexts(scanned: DataFrame, rounds: int = 3, least: float = 0.6,
                       support: int = 3) -> DataFrame:
    """(context) whose instances are mostly identifiers.

    An instance that a form found has score 1, any other 1 - the product of (1 - confidence)
    over the confident contexts that it occurs in, so 0 at first. A context's confidence is
    the mean score of its distinct instances. In each of the `rounds` turns the contexts that
    reach `least`, with at least `support` instances and two or more of them found by a form
    or by confident contexts, become confident, and their confidence stays as it is then. So
    a context is judged only by forms and by contexts that were confident before it: its own
    vote for an instance never comes back to it, on any way. Edges are counted once however
    often they occur, so a hot context or instance is one row per task before it is shuffled.
    """
    edges = checkpointed(
        scanned.select(F.explode("instances").alias("i")).select("i.context", "i.form", "i.known")
        .groupBy("context", "form").agg(F.max("known").alias("known")))
    good = None
    for _ in range(rounds):
        score = F.col("known").cast("double")
        current = edges
        if good is not None:
            # 1 - prod(1 - c), kept away from log(0)
            doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
            spread = (edges.join(good, "context").groupBy("form")
                      .agg((1 - F.exp(doubt)).alias("spread")))
            current = edges.join(spread, "form", "left")
            score = F.when(F.col("known"), 1.0).otherwise(F.coalesce("spread", F.lit(0.0)))
        new = (current.withColumn("score", score).groupBy("context")
               .agg(F.avg("score").alias("confidence"), F.count("*").alias("n"),
                    F.count_if(F.col("score") > 0).alias("found"))
               .where((F.col("n") >= support) & (F.col("found") >= 2)
                      & (F.col("confidence") >= least)).select("context", "confidence"))
        good = checkpointed(new if good is None else
                            good.union(new.join(good, "context", "left_anti")))
    return good.select("context")


def entities(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added) of each row: spans (kind, start, end) in code points.

    `base` is in the order of kinds, then start. `added` holds instances of confident
    contexts, which never overlap a base span. A null or empty text has none; repeated rows
    are judged each; other columns are ignored; an empty table gives no rows.
    """
    scanned = checkpointed(scan(docs))
    contexts = confident_contexts(scanned)
    named = F.array(*[F.lit(k) for k in KINDS])
    told = F.transform("base", lambda s: F.struct(
        F.get(named, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    new = (scanned.select("row", F.explode("instances").alias("i")).where("not i.known")
           .select("row", "i.context", "i.start", "i.end").join(contexts, "context")
           .groupBy("row").agg(F.array_sort(F.collect_set(F.struct(
               F.lit(FOUND).alias("kind"), "start", "end"))).alias("added")))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return (scanned.select("row", "doc_id", told.alias("base")).join(new, "row", "left")
            .select("doc_id", "base", F.coalesce("added", empty).alias("added")))


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256 and spans of `entities`."""
    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    base = spans_text(F.col("base"))
    every = spans_text(F.concat("base", "added"))
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))


def mask(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """`text` with each span as [KIND]; spans that overlap an earlier one extend it."""
    if not text or not spans:
        return text
    parts, done = [], 0
    for start, end, kind in sorted(spans):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def masked(docs: DataFrame, broadcast_contexts: int = 200_000) -> DataFrame:
    """`docs` with personal data replaced by its kind, and n_chars (if there) to match.

    Contexts are learned in a first pass over all texts; the second finds the spans again
    beside each row, so no text is shuffled while the contexts are few enough to broadcast.
    More of them are joined to the rows that use them, and those to the texts.
    """
    scanned = checkpointed(scan(docs))
    contexts = checkpointed(confident_contexts(scanned))
    few = contexts.count() <= broadcast_contexts
    good = docs.sparkSession.sparkContext.broadcast(
        frozenset(r["context"] for r in contexts.collect()) if few else None)
    schema = T.StructType(docs.schema.fields)
    if not few:
        used = (scanned.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"),
                               F.explode("instances.context").alias("context"))
                .join(contexts, "context").groupBy("__id", "__hash")
                .agg(F.collect_set("context").alias("__good")))
        docs = docs.join(used, F.col("doc_id").eqNullSafe(F.col("__id")) & (
            text_hash() == F.col("__hash")), "left").drop("__id", "__hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches):
            columns = dict(zip(batch.schema.names, batch.columns))
            old = columns["text"].to_pylist()
            allowed = ([good.value] * len(old) if few
                       else [set(c or ()) for c in columns.pop("__good").to_pylist()])
            texts = []
            for text, own in zip(old, allowed):
                base, instances = scan_text(text or "")
                spans = [(a, b, KINDS[k]) for k, a, b in base]
                spans += [(a, b, FOUND) for c, _, known, a, b in instances
                          if not known and c in own]
                texts.append(mask(text, spans))
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(
                    [len(t) if t != o else n for t, o, n in
                     zip(texts, old, columns["n_chars"].to_pylist())], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, schema)
