"""Personal data, and terms that give it away: information-theoretic sanitisation with DataFrame functions only.

Base spans are matches of fixed patterns. Every value found is a protected entity. The words of a whole text outside its base
spans are terms. How strongly a term reveals an entity is their pointwise mutual information, PMI = log2(n(entity, term) N /
(n(entity) n(term))), against the entity's own information IC = log2(N / n(entity)). All numbers count distinct texts of the
whole corpus, so copies change nothing. In documents that hold the entity, terms that reveal at least `generalise` of IC are
replaced by a placeholder, from `remove` on they are taken out, if they meet the entity more often than chance explains: were
they independent, so many common texts would have a probability of at most exp(-n(entity) KL(n(entity, term) / n(entity) ||
n(term) / N)) (Hoeffding), which must not exceed `alpha` over the number of pairs of an entity and a word of the corpus (Bonferroni).
A rare word in the one text of an entity meets it once, which chance explains in all but small vocabularies.

Results for special cases: a null or empty text has no spans; repeated rows are kept; rows with one text
have the same spans, whatever their ids, which are not read; ties between spans go by kind; an empty table gives an
empty result; other columns stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

# The kinds in order and their patterns. Possessive repeats and the look-behinds find the same matches as the
# plain patterns in one pass over long runs of characters; of cards only runs of 14 to 19 digits match.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[\p{L}][\p{L}\p{Nd}]{2,}"
_SPAN = "array<struct<start:int,ord:int,kind:string,end:int,value:string>>"
#: Rows up to which a table of terms is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 50_000


def _let(value: Column, use) -> Column:
    """`use` of the value, which is worked out once however often it is used: what a lambda takes from outside is evaluated at every element."""
    return F.transform(F.array(value), use)[0]


#: Elements of a block, see `_prefix` and `_replaced`.
_BLOCK = 256


def _blocks(every: Column) -> Column:
    """0, 1, ... for each block of a non-empty array."""
    return F.sequence(F.lit(0), ((F.size(every) - 1) / _BLOCK).cast("int"))


def _prefix(values: Column, op) -> Column:
    """For each number of an array, `op` (sum or greatest, from 0 on) over it and those before it.

    A fold would copy all its results at each step; here blocks are put together first, then what lies before each block, then each
    number with those before it in its block.
    """
    fold = lambda part: F.aggregate(part, F.lit(0), op)

    def each(every: Column, before: Column) -> Column:
        own = lambda i: F.slice(every, (i - i % _BLOCK + 1).cast("int"), i % _BLOCK + 1)
        return F.transform(every, lambda x, i: op(F.get(before, (i / _BLOCK).cast("int")), fold(own(i))))

    def whole(every: Column) -> Column:
        blocks = F.transform(_blocks(every), lambda i: fold(F.slice(every, (i * _BLOCK + 1).cast("int"), _BLOCK)))
        before = lambda done: F.transform(done, lambda x, i: fold(F.slice(done, 1, i)))
        return _let(blocks, lambda done: _let(before(done), lambda b: each(every, b)))

    return _let(values, lambda every: F.when(F.size(every) > 0, whole(every)).otherwise(F.array().cast("array<int>")))


def matches(text: Column, pattern: Column, kind: str, order: int) -> Column:
    """Leftmost non-overlapping matches as spans in code points."""
    # the last part of the text, after all matches, has no match beside it
    pairs = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("before"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("value")), lambda p: p["value"].isNotNull())

    def spans(every: Column) -> Column:
        ends = _prefix(F.transform(every, lambda p: F.char_length(p["before"]) + F.char_length(p["value"])), lambda a, b: a + b)
        one = lambda x: F.struct((x["end"] - F.char_length(x["pair"]["value"])).alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["pair"]["value"].alias("value"))
        return F.transform(F.arrays_zip(every.alias("pair"), ends.alias("end")), one).cast(_SPAN)

    return F.when(F.rlike(text, pattern), _let(pairs, spans)).otherwise(F.array().cast(_SPAN))


def _replaced(text: Column, spans: Column, shown) -> Column:
    """The text with `shown(span)` in place of each span. Of spans that overlap the first is shown and all are taken out.

    The text is taken apart for a block of spans at a time, so it is not read from its start for each.
    """

    def cuts_of(every: Column) -> Column:
        reached = _prefix(F.transform(every, lambda s: s["end"]), lambda a, b: F.greatest(a, b))

        def cut(x: Column, i: Column, ends: Column) -> Column:
            at = F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
            return F.struct(F.greatest(x["start"], at).alias("start"), F.get(ends, i).alias("end"), F.when(x["start"] >= at, shown(x)).otherwise("").alias("shown"))

        return _let(reached, lambda ends: F.transform(every, lambda x, i: cut(x, i, ends)))

    def put(cuts: Column) -> Column:
        ended = lambda i: F.when(i > 0, F.get(cuts, (i - 1).cast("int"))["end"]).otherwise(0)
        last = F.size(cuts)

        def block(i: Column) -> Column:
            own, start = F.slice(cuts, (i * _BLOCK + 1).cast("int"), _BLOCK), ended(i * _BLOCK)
            length = ended(F.least((i + 1) * _BLOCK, last)) - start
            whole = F.struct(own.alias("own"), start.alias("start"), F.substring(text, start + 1, length).alias("part"))
            gap = lambda w, c, at: F.substring(w["part"], at - w["start"] + 1, c["start"] - at)
            each = lambda w: F.transform(w["own"], lambda c, k: F.concat(gap(w, c, F.when(k > 0, F.get(w["own"], k - 1)["end"]).otherwise(w["start"])), c["shown"]))
            return _let(whole, lambda w: F.array_join(each(w), ""))

        parts = F.transform(_blocks(cuts), block)
        return F.concat(F.array_join(parts, ""), F.substring(text, ended(last) + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, _let(_let(spans, cuts_of), put)).otherwise(text)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    values = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(values, F.lit(0), lambda total, d: total + F.when(d > 9, d - 9).otherwise(F.coalesce(d, F.lit(0)))) % 10 == 0


def base_spans(text: Column) -> Column:
    """All valid matches of the four kinds, by start, then kind."""
    valid = {
        "email": lambda v: F.lit(True),
        "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: p.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})$")),
        "card": _luhn,
        "phone": lambda v: F.length(_digits(v)).between(10, 15),
    }

    def checked(kind: str, order: int) -> Column:
        return F.filter(matches(text, F.lit(PATTERNS[kind]), kind, order), lambda s: valid[kind](s["value"]))

    found = [checked(kind, order) for order, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def describe(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"]).otherwise(_digits(span["value"]))
    return F.concat_ws(":", span["kind"], value)


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))


def revealing_terms(docs: DataFrame, mentions: DataFrame, generalise: float, remove: float, alpha: float) -> DataFrame:
    """(entity, term, gone): terms that reveal a share `generalise` of the entity's information; gone from `remove` on.

    `docs` has text and its hash; `mentions` has for each document with entities the hash and the arrays `entities` and `terms`.
    Entities and pairs that can't pass even with the least numbers of terms that the texts with mentions show are ruled
    out before terms are counted over the corpus.
    """
    texts = materialise(mentions.groupBy("hash").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms")))
    entities = materialise(texts.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")))
    at_least = materialise(texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term")))
    n_entities, n_words = entities.count(), at_least.count()
    nothing = entities.select("entity", F.lit("").alias("term"), F.lit(False).alias("gone")).limit(0)
    if n_words == 0:
        return nothing
    total = F.lit(float(docs.select("hash").distinct().count()))
    n_both, n_entity, n_term = F.col("n_both"), F.col("n_entity"), F.col("n_term")
    apart = F.when(n_both < n_entity, (n_entity - n_both) * (F.log(1 - n_both / n_entity) - F.log(1 - n_term / total))).otherwise(0.0)
    nats = n_both * F.log(n_both * total / (n_entity * n_term)) + apart

    def reveals(share: float) -> Column:
        return F.log(n_both * total / (n_entity * n_term)) >= share * F.log(total / n_entity)

    def needed(words: int) -> float:
        return math.log(n_entities * words / alpha)

    possible = materialise(entities.filter(n_entity * F.log(total / n_entity) >= needed(n_words)))
    n_possible = possible.count()
    if n_possible == 0:
        return nothing
    pairs = texts.select(F.explode("entities").alias("entity"), "terms")
    if n_possible <= BROADCAST_ROWS:
        pairs = pairs.join(F.broadcast(possible.select("entity")), "entity", "left_semi")
    both = pairs.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    candidates = both.join(possible, "entity").join(at_least, "term").filter(reveals(generalise) & (nats >= needed(n_words)))
    candidates = materialise(candidates.drop("n_term"))
    terms = materialise(candidates.select("term").distinct())
    n_terms = terms.count()
    if n_terms == 0:
        return nothing
    wanted = terms.withColumn("wanted", F.lit(True))
    words = docs.select("hash", F.explode(_terms(F.lower("text"))).alias("term"))
    words = words.join(F.broadcast(wanted) if n_terms <= BROADCAST_ROWS else wanted, "term", "left")
    words = materialise(words.select("term", F.when(F.col("wanted"), F.col("hash")).alias("hash")).distinct())
    elsewhere = words.filter("hash is not null").join(texts.select("hash"), "hash", "left_anti").groupBy("term").agg(F.count(F.lit(1)).alias("more"))
    holding = terms.join(at_least, "term").join(elsewhere, "term", "left").select("term", (n_term + F.coalesce("more", F.lit(0))).alias("n_term"))
    found = candidates.join(holding, "term").filter(reveals(generalise) & (nats >= needed(words.select("term").distinct().count())))
    return found.select("entity", "term", reveals(remove).alias("gone"))


def find(docs: DataFrame, text_col: str = "text", generalise: float = 0.9, remove: float = 0.97, alpha: float = 0.05) -> DataFrame:
    """`docs` with `pii_base` and `pii_spans` (arrays of spans) and `pii_text`, the text with all spans replaced or taken out."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(text.alias("text"), F.md5(text.cast("binary")).alias("hash")).withColumn("base", base_spans(F.col("text")))
    entities = F.array_distinct(F.transform("base", _entity))
    terms = _terms(F.lower(_replaced(F.col("text"), F.col("base"), lambda s: F.lit(" "))))
    mentions = materialise(rows.filter(F.size("base") > 0).select("hash", entities.alias("entities"), terms.alias("terms")))
    revealing = materialise(revealing_terms(rows, mentions, generalise, remove, alpha))
    marked = docs.withColumn("pii_base", base_spans(text))
    n_revealing = revealing.count()
    if n_revealing == 0:
        marked = marked.withColumn("_soft", F.lit(None).cast("array<string>")).withColumn("_hard", F.lit(None).cast("array<string>"))
    else:
        # by text: rows with one text have the same terms, whatever their ids
        holders = mentions.select("hash", F.explode("entities").alias("entity")).distinct()
        held = holders.join(F.broadcast(revealing) if n_revealing <= BROADCAST_ROWS else revealing, "entity")
        held = held.groupBy(F.col("hash").alias("_hash")).agg(F.collect_set(F.when(~F.col("gone"), F.col("term"))).alias("_soft"), F.collect_set(F.when(F.col("gone"), F.col("term"))).alias("_hard"))
        held = materialise(held)
        marked = marked.join(F.broadcast(held) if held.count() <= BROADCAST_ROWS else held, F.md5(text.cast("binary")) == F.col("_hash"), "left").drop("_hash")

    def term_spans(column: str, kind: str, order: int) -> Column:
        longest_first = F.array_sort(F.col(column), lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{Nd}])(?:"), F.array_join(longest_first, "|"), F.lit(r")(?![\p{L}\p{Nd}])"))
        found = _let(F.col("_masked"), lambda m: matches(m, pattern, kind, order))
        return F.when(F.size(column) > 0, found).otherwise(F.array().cast(_SPAN))

    if n_revealing:
        # terms are sought beside base spans, whose places hold as many line ends instead
        masked = _replaced(text, F.col("pii_base"), lambda s: F.repeat(F.lit("\n"), s["end"] - s["start"]))
        marked = marked.withColumn("_masked", F.when(F.coalesce(F.size("_soft"), F.lit(0)) + F.coalesce(F.size("_hard"), F.lit(0)) > 0, masked))
    else:
        marked = marked.withColumn("_masked", F.lit(None).cast("string"))
    marked = marked.withColumn("pii_spans", F.array_sort(F.concat("pii_base", term_spans("_soft", "term", 4), term_spans("_hard", "removed", 5)))).drop("_soft", "_hard", "_masked")

    shown = _replaced(text, F.col("pii_spans"), lambda s: F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))
    return marked.withColumn("pii_text", F.when(F.col(text_col).isNotNull(), shown))
