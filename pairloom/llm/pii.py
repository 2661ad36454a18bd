"""Personal data: fixed forms, and identifiers found by bootstrapped contexts.

E-mail addresses, IP addresses, payment cards and phone numbers have fixed
forms.  Together with long hexadecimal secrets, their values are the seeds of a
bootstrap: a lexical pattern is a label and the sign that ties it to a value,
such as ``password=`` or ``phone: ``.  Patterns and values form a graph.  In
each of ROUNDS rounds a pattern's confidence for a kind is the mean score of its
values, and a value's score is the greatest confidence of its patterns, or 1
for a seed.  Every value of a pattern with enough confidence and support is
then taken for an identifier of that kind, whatever its form.

The words around an identifier are patterns too: the two before it, such as
``token is``, and one on either side.  There the seeds are all words that begin
with a form, a pattern must hold a share of the seeds of its kind, and only values of patterns with enough confidence are carried to
the next round.  Values of labels and of words are not carried to each other.

All is DataFrame functions.  Candidates are found once, stored, and both make
the graph and give the places of what was discovered.

Defined results: a null text counts as empty and has no spans.  Repeated rows
give repeated results.  An empty table gives no rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.spans import blocks, free, let, running, spans
from pairloom.session import staged

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
ALL_KINDS = (*KINDS, SECRET)
ROUNDS = 3
CONFIDENCE = 0.7
#: Different values with the score of a seed that a pattern must have, added up.
SUPPORT = 3
#: A pattern of plain words must also hold this share of all seeds of its kind.  Pairs of common words
#: stand around seeds by chance, in proportion to their number: the commonest pair of a text is some
#: hundredth of all pairs, so an absolute number would let more and more of them through.
SHARE = 0.02

#: Fixed forms.  A run of characters is entered from its start alone, and never given back:
#: either saves trials that can't succeed, and changes no match.
_LOCAL = "A-Za-z0-9._%+-"
FORMS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GATES = {"email": "@", "phone": "+"}
_SECRET_FORM = "^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{16,}$"

#: A label, its tie and a value of any length; final punctuation is given back.  ``{3,}`` in
#: one piece would recurse in the JVM where characters of different width alternate.  Groups
#: of digits with single blanks between them are one value, if no other form ends before them.
_ENDS = r"(?=[.!?)]*(?:[\s\"',;]|$))"
_IP = rf"[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{_ENDS}"
_NUMBERS = rf"[+(]{{0,2}}[0-9](?:[().-]{{0,2}}\x20?[().-]{{0,2}}[0-9]){{3,}}+{_ENDS}"
_VALUE = rf"(?:{_IP}|{_NUMBERS}|[^\s\"',;]{{3}}[^\s\"',;]*[^\s\"',;.!?)])"
_CONTEXT = rf"(?<![A-Za-z_])([A-Za-z_]{{2,}}+)([\"']?\x20?[=:]\x20?[\"']?)({_VALUE})"

#: Where a word begins; a single blank between digits doesn't end one.
_GAP = r"(?<=\s)(?=\S)(?!(?<=[0-9)]\x20)\(?[0-9])"
_OPENS = r"^[\"'\[<{]*"
_WORD_VALUE = rf"{_OPENS}([^\t\n\x0B\f\r\"',;]*[^\s\"',;.!?)])"
_HEX = r"(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])"

FOUND = "array<struct<start:int,order:int,end:int,kind:string>>"


# ------------------------------------------------------------------------ fixed forms
def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check: every second digit from the right is doubled."""
    def value(digit: Column, place: Column) -> Column:
        number = digit.cast("int") * F.when(place % 2 == 1, 2).otherwise(1)
        return F.when(number > 9, number - 9).otherwise(number)

    each = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(each, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        # long runs of zeros are still numbers; what is longer than three digits without them is above 255
        parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(found)).between(14, 19) & _luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    return F.lit(True)


def form_spans(text: Column, kind: str) -> Column:
    """All valid matches of one fixed form."""
    may = F.contains(text, F.lit(_GATES[kind])) if kind in _GATES else F.rlike(text, F.lit("[0-9]"))
    valid = F.filter(spans(text, F.lit(FORMS[kind])), lambda s: _valid(kind, s["found"]))
    made = F.transform(valid, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")
    ))
    return F.when(may, made).otherwise(F.array().cast(FOUND))


def _kinds_of(value: Column) -> Column:
    """The kinds whose form a whole value has."""
    def whole(kind: str) -> Column:
        body = FORMS[kind].replace(rf"(?:(?<![{_LOCAL}])|\G)", "").replace("(?<![0-9]{2})", "")
        return F.rlike(value, F.lit(f"^(?:{body})$")) & _valid(kind, value)

    named = [F.when(whole(kind), kind) for kind in KINDS] + [F.when(F.rlike(value, F.lit(_SECRET_FORM)), SECRET)]
    return F.filter(F.array(*named), lambda k: k.isNotNull())


# ------------------------------------------------------------------------ bootstrap
def _row_key(id_col: str, text: Column) -> list[Column]:
    """Names a row by its id and text; rows alike in both have the same spans."""
    return [F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("row_id"), F.xxhash64(text).alias("row_hash")]


def candidates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(row_id, row_hash, pattern, value, start, end)``: all labelled values of all texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    labelled = docs.filter(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")))
    found = labelled.select(*_row_key(id_col, text), F.explode(spans(text, F.lit(_CONTEXT))).alias("s"))

    def group(n: int) -> Column:
        return F.regexp_extract("s.found", _CONTEXT, n)

    parts = found.select("row_id", "row_hash", "s.end", F.concat(F.lower(group(1)), group(2)).alias("pattern"), group(3).alias("value"))
    return parts.select("row_id", "row_hash", "pattern", "value", (F.col("end") - F.length("value")).alias("start"), "end")


def patterns(found: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: float = SUPPORT) -> DataFrame:
    """``(pattern, kind, confidence, support)`` of the patterns to trust, learned from the stored candidates."""
    # both are read in every round; as stored tables of known size they are also sent whole where they are small
    edges = staged(found.select("pattern", "value").distinct(), "edges")
    values = edges.select("value").distinct().select("value", F.explode(_kinds_of(F.col("value"))).alias("kind"))
    seeds = staged(values.withColumn("score", F.lit(1.0)), "seeds")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    scores = seeds
    for turn in range(rounds):
        # one unknown value more than were seen, so that a few values don't make a pattern certain
        sums = edges.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
        rated = staged(sums.join(sizes, "pattern").select("pattern", "kind", (F.col("support") / (F.col("n") + 1)).alias("confidence"), "support"), "patterns")
        if turn < rounds - 1:
            carried = edges.join(rated.filter(F.col("support") >= support), "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("score"))
            scores = carried.unionByName(seeds).groupBy("value", "kind").agg(F.max("score").alias("score"))
    return rated.filter((F.col("confidence") >= confidence) & (F.col("support") >= support))


def _words(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``(row_id, row_hash, pos, word, pattern)``: every word with the two before it, and with one on either side."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*_row_key(id_col, text), F.split(text, _GAP, -1).alias("words"))
    none = F.lit("")
    near = F.arrays_zip(
        F.col("words").alias("word"), F.concat(F.array(none), F.col("words")).alias("last"),
        F.concat(F.array(none, none), F.col("words")).alias("second"), F.slice("words", 2, F.size("words")).alias("next"),
    )
    each = rows.select("row_id", "row_hash", F.posexplode(near).alias("pos", "s")).select("row_id", "row_hash", "pos", "s.*").filter("word IS NOT NULL")

    def plain(word: str) -> Column:
        return F.lower(F.rtrim(F.col(word), F.lit(" \t\n\x0b\f\r")))

    before = F.when((F.col("second") != "") & (F.col("last") != ""), F.concat(plain("second"), F.lit(" "), plain("last"), F.lit(" _")))
    around = F.when((F.col("last") != "") & (F.col("next") != ""), F.concat(plain("last"), F.lit(" _ "), plain("next")))
    return each.select("row_id", "row_hash", "pos", "word", F.explode(F.array(before, around)).alias("pattern")).filter("pattern IS NOT NULL")


def _word_seeds(words: DataFrame) -> DataFrame:
    """``(pattern, value, kind)`` of the words that begin with a valid form."""
    def body(kind: str) -> str:
        return _HEX if kind == SECRET else FORMS[kind].replace(rf"(?:(?<![{_LOCAL}])|\G)", "").replace("(?<![0-9]{2})", "")

    def made(kind: str) -> Column:
        found = F.regexp_extract("word", f"{_OPENS}({body(kind)})", 1)
        return F.when((found != "") & _valid(kind, found), F.struct(found.alias("value"), F.lit(kind).alias("kind")))

    some = words.filter(F.rlike("word", F.lit("[0-9@]")))
    return some.select("pattern", F.explode(F.array(*map(made, ALL_KINDS))).alias("seed")).filter("seed IS NOT NULL").select("pattern", "seed.*").distinct()


def word_spans(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rounds: int = ROUNDS, confidence: float = CONFIDENCE,
    support: float = SUPPORT, share: float = SHARE,
) -> DataFrame | None:
    """``(row_id, row_hash, start, end, kind)``: the values of trusted patterns of plain words; None if there is no such pattern.

    The texts are read again in each round, since the words of all texts are
    too many to store: only those of patterns that have support are kept, and
    each pattern's words are looked up once.
    """
    words = _words(docs, text_col, id_col)
    value = F.regexp_extract("word", _WORD_VALUE, 1)
    scored = staged(_word_seeds(words).withColumn("score", F.lit(1.0)), "word_seeds")
    seeds = scored.select("value", "kind").distinct().groupBy("kind").agg(F.greatest(F.lit(support), share * F.count(F.lit(1))).alias("least"))
    trusted = met = None
    for turn in range(rounds):
        sums = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
        sums = staged(sums.join(F.broadcast(seeds), "kind").filter(F.col("support") >= F.col("least")).drop("least"), "word_sums")
        new = sums.select("pattern").distinct()
        if met is not None:
            new = staged(new.join(met.select("pattern").distinct(), "pattern", "left_anti"), "word_new")
        if not new.isEmpty():
            here = staged(words.join(new, "pattern").withColumn("value", value), "word_met")
            met = here if met is None else met.unionByName(here)
        if met is None:
            break
        sizes = met.select("pattern", "value").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
        rated = sums.join(sizes, "pattern").withColumn("confidence", F.col("support") / (F.greatest("n", "support") + 1))
        best = rated.groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("best")).select("pattern", "best.*")
        trusted = staged(best.filter(F.col("confidence") >= confidence), "word_patterns")
        if turn == rounds - 1 or trusted.isEmpty():
            break
        # what the patterns found is looked for in other contexts; without new values all scores stay
        carried = met.join(trusted, "pattern").filter("value != ''").groupBy("value", "kind").agg(F.max("confidence").alias("score"))
        carried = staged(carried.join(scored.select("value", "kind").distinct(), ["value", "kind"], "left_anti"), "word_values")
        if carried.isEmpty():
            break
        elsewhere = words.withColumn("value", value).join(carried, "value").select("pattern", "value", "kind", "score")
        scored = staged(scored.unionByName(elsewhere).groupBy("pattern", "value", "kind").agg(F.max("score").alias("score")), "word_scores")
    if trusted is None or trusted.isEmpty():
        return None
    hits = met.join(trusted, "pattern").filter("value != ''")
    hits = hits.groupBy("row_id", "row_hash", "pos").agg(F.max(F.struct("confidence", "kind")).alias("best"))
    # stored, so that its size is known: while it is small no text is shuffled
    places = staged(hits.groupBy("row_id", "row_hash").agg(F.collect_list(F.struct("pos", F.col("best.kind").alias("kind"))).alias("hits")), "word_places")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*_row_key(id_col, text), F.split(text, _GAP, -1).alias("words")).join(places, ["row_id", "row_hash"]).dropDuplicates(["row_id", "row_hash"])
    lengths = let(F.transform("words", lambda w: F.length(w)), lambda n: running(n, F.lit(0), lambda now, x: now + x))
    each = rows.withColumn("at", lengths).select("row_id", "row_hash", F.explode(F.transform("hits", lambda h: F.struct(
        h["kind"].alias("kind"), F.get("words", h["pos"]).alias("word"), F.get("at", h["pos"]).alias("before")
    ))).alias("h")).select("row_id", "row_hash", "h.*")
    start = F.col("before") + F.length(F.regexp_extract("word", _OPENS, 0))
    return each.select("row_id", "row_hash", start.alias("start"), (start + F.length(value)).alias("end"), "kind")


def _discovered(found: DataFrame, trusted: DataFrame, by_words: DataFrame | None = None) -> DataFrame:
    """``(row_id, row_hash, extra, worded)``: spans of the trusted patterns' values, of labels and of words, by row."""
    best = trusted.groupBy("pattern").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    order = functools.reduce(lambda a, k: a.when(F.col("kind") == k, ALL_KINDS.index(k)), ALL_KINDS[1:], F.when(F.col("kind") == ALL_KINDS[0], 0))
    span = F.struct(F.col("start"), order.alias("order"), F.col("end"), F.col("kind"))
    rows = found.join(best, "pattern").select("row_id", "row_hash", span.alias("label"), F.lit(None).cast(FOUND[6:-1]).alias("word"))
    if by_words is not None:
        rows = rows.unionByName(by_words.select("row_id", "row_hash", F.lit(None).cast(FOUND[6:-1]).alias("label"), span.alias("word")))
    return rows.groupBy("row_id", "row_hash").agg(F.collect_set("label").alias("extra"), F.collect_set("word").alias("worded"))


def find(docs: DataFrame, keep: list[str], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The columns ``keep`` of all rows, ``base_spans`` and ``all_spans``; spans are ``{start, order, end, kind}`` in order.

    Discovered spans that overlap one of a fixed form are left out, and those
    of plain words also where they overlap a labelled one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = staged(candidates(docs, text_col, id_col), "candidates")
    extra = staged(_discovered(found, patterns(found), word_spans(docs, text_col, id_col)), "discovered")
    base = F.array_sort(F.flatten(F.array(*[form_spans(text, kind) for kind in KINDS])))
    # the names of a fresh struct can't clash with those of the rows
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), *_row_key(id_col, text), base.alias("base_spans"))
    joined = rows.join(extra, ["row_id", "row_hash"], "left")

    labelled = free(F.coalesce("extra", F.array().cast(FOUND)), F.col("base_spans"))
    some = joined.select("row", "base_spans", labelled.alias("labelled"), F.coalesce("worded", F.array().cast(FOUND)).alias("worded"))
    worded = free(F.col("worded"), F.concat("base_spans", "labelled"))
    return some.select("row", "base_spans", F.array_sort(F.concat("base_spans", "labelled", worded)).alias("all_spans"))


def spans_text(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def summary(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the spans of fixed forms, and all spans of every row."""
    found = find(docs, ["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id", *[count(kind) for kind in KINDS],
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"), spans_text(F.col("all_spans")).alias("spans"),
    )


# ------------------------------------------------------------------------ redaction
def redacted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced as one."""
    def cut(ordered: Column) -> Column:
        # where the text before a span begins: at the furthest end of those before it
        at = running(ordered, F.lit(0), lambda now, x: F.greatest(now, x["end"]))
        each = F.zip_with(ordered, at, lambda x, now: F.struct(now.alias("from"), x["start"].alias("to"), x["kind"].alias("kind")))
        return let(F.filter(each, lambda x: x["to"] >= x["from"]), lambda cuts: F.array_join(F.transform(blocks(cuts), written), ""))

    def written(some: Column) -> Column:
        """One block: its part of the text is taken once, so that the whole text isn't counted through for each span."""
        first, last = F.get(some, F.lit(0))["from"], F.element_at(some, -1)["to"]
        part = F.substring(text, first + 1, last - first)
        return let(part, lambda own: F.array_join(F.transform(some, lambda x: F.concat(
            F.substring(own, x["from"] - first + 1, x["to"] - x["from"]), F.lit("["), F.upper(x["kind"]), F.lit("]")
        )), ""))

    rest = F.substring(text, F.array_max(F.transform(found, lambda x: x["end"])) + 1, F.length(text))
    return F.when(F.size(found) == 0, text).otherwise(F.concat(let(found, cut), rest))


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with the personal data in ``text`` replaced."""
    found = find(docs, docs.columns).select("row.*", F.struct("all_spans").alias("_found_spans"))
    clean = redacted(F.col("text").cast("string"), F.col("_found_spans.all_spans"))
    return found.select(*[F.when(F.col("text").isNotNull(), clean).alias("text") if c == "text" else F.col(c) for c in docs.columns])
