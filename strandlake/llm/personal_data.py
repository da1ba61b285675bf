"""Personal data by bootstrapped contexts (operator 12), with DataFrame functions only.

Patterns settle the sure cases (the base). Their surroundings, as lexical patterns, are then
scored against all identifier-like strings of the corpus, round by round, and confident
patterns name identifiers that no base pattern describes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

KINDS = ["email", "ip", "card", "phone"]
CANDIDATE = len(KINDS)

#: What the base matches. They find the same as the plain patterns
#:   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#:   [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#:   [0-9]([\x20-]?[0-9])+
#:   \+[0-9][\x20().0-9-]+[0-9]
#: but begin only where a run begins (or the last match ended) and never give a run back, so
#: that a run of any length is read once and without recursion.
BASE = [
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
#: a part of an address of at most 255, any number of zeros before it
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: what may be an identifier: addresses written otherwise, colon-separated hexadecimal groups, numbers
_AT = r"(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20(?=[A-Za-z0-9-]+\x20dot\x20))"
_DOT = r"(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
LIKE_EMAIL = rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*+"
LIKE_IP = r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Za-z:])"
LIKE_NUMBER = r"(?<![0-9A-Za-z])[(]?[0-9](?:[\x20()./-]{0,2}[0-9])++[0-9A-Za-z]*+"
LIKE = f"{LIKE_EMAIL}|{LIKE_IP}|{LIKE_NUMBER}"

#: characters of context kept on either side, and of one word of it
CONTEXT, WORD = 64, 24
#: distinct identifiers of one kind that a pattern needs, and the score from which it (and what it finds) is believed
SUPPORT, BELIEVED = 3, 0.7
#: weight of an undecided string beside a decided one of another kind
UNDECIDED = 0.1
ROUNDS = 3

_OTHER = "other"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the check sum."""
    backwards = F.reverse(F.substring(digits, 1, 19))
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(backwards), F.lit(1))), F.lit(0),
        lambda acc, i: acc + F.coalesce(
            F.when(i % 2 == 1, F.substr(backwards, i, F.lit(1))).otherwise(
                # twice the digit, less 9 if that has two
                F.translate(F.substr(backwards, i, F.lit(1)), "0123456789", "0246813579")).try_cast("int"), F.lit(0)))
    return total % 10 == 0


def _matches(text: Column, kind: int, pattern: str, needed: Column) -> Column:
    """Array of (kind, pos, gap, text, before, after) of all matches from left to right; gap: code points since the last one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = "array<struct<kind:int,pos:int,gap:bigint,text:string,before:string,after:string>>"
    rows = F.transform(
        F.arrays_zip(found.alias("found"), F.slice(gaps, 1, F.size(found)).alias("gap"),
                     F.slice(gaps, 2, F.size(found)).alias("rest")),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), F.length(m["gap"]).cast("long").alias("gap"), m["found"].alias("text"),
            F.right(m["gap"], F.lit(CONTEXT)).alias("before"), F.left(m["rest"], F.lit(CONTEXT)).alias("after")))
    return F.when(needed, rows).otherwise(F.array().cast(none))


def _valid(kind: Column, text: Column) -> Column:
    digits = _digits(text)
    n = F.length(digits)
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, text.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$"))
        .when(kind == 2, n.between(14, 19) & _luhn(digits))
        .when(kind == 3, n.between(10, 15))
        .otherwise(F.lit(False))
    )


def _may_be(text: Column) -> Column:
    """Kinds that a string outside the base might be of: numbers of the usual lengths, addresses written otherwise."""
    digits = _digits(text)
    n = F.length(digits)
    number = text.rlike(r"^[0-9()./\x20-]+$")
    return (
        F.when(text.rlike(r"@|\bat\b"), F.array(F.lit("email")))
        .when(text.contains(":"), F.array(F.lit("ip")))
        .when(number, F.array_compact(F.array(
            F.when(n.between(12, 19) & _luhn(digits), F.lit("card")), F.when(n.between(7, 13), F.lit("phone")))))
        .otherwise(F.array().cast("array<string>"))
    )


def _words(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), "[0-9]", "0")
    return F.filter(F.split(plain, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def _patterns(before: Column, after: Column) -> Column:
    """Lexical patterns of a mention: the two words before it; the word before it and the word after it."""
    left, right = _words(before), _words(after)
    cut = lambda c: F.substring(c, 1, WORD)
    last, last_but_one, following = (cut(F.get(left, F.size(left) - 1)), cut(F.get(left, F.size(left) - 2)), cut(F.get(right, F.lit(0))))
    return F.array_compact(F.array(
        F.concat(last_but_one, F.lit(" "), last, F.lit(" _")), F.concat(last, F.lit(" _ "), following)))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, mentions), both written tables.

    documents: doc_id, mark (hash of the text). mentions: those of the base and, outside
    of them, what may be an identifier: doc_id, mark, kind (null if not base), start,
    end, may (kinds it might be of), instance, patterns. A repeated row has its mentions once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digit = text.rlike("[0-9]")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        "doc_id", F.xxhash64(text).alias("mark"), F.concat(
            _matches(text, 0, BASE[0], text.contains("@")), _matches(text, 1, BASE[1], digit), _matches(text, 2, BASE[2], digit),
            _matches(text, 3, BASE[3], text.contains("+")),
            _matches(text, CANDIDATE, LIKE, digit | text.contains("@") | text.rlike(r"[(\[\x20]at[)\]\x20]"))).alias("found"))
    read = stage(rows, "personal_data_read")
    key = ["doc_id", "mark"]
    each = (
        read.filter(F.size("found") > 0).groupBy(*key).agg(F.any_value("found").alias("found"))
        .select(*key, F.inline("found"))
    )
    along = Window.partitionBy(*key, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.length("text")).over(along)).withColumn("start", F.col("end") - F.length("text"))
    kind = F.col("kind")
    judged = placed.withColumn("base", _valid(kind, F.col("text"))).filter(
        F.col("base") | (kind == CANDIDATE) & (F.col("text").rlike(r"@|\bat\b|:") | (F.length(_digits(F.col("text"))) >= 4)))
    # a candidate counts only where it meets no match of the base: none begins before it and goes on, none begins within
    forward = Window.partitionBy(*key).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backward = Window.partitionBy(*key).orderBy(F.desc("start"), "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = judged.withColumns({
        "ended": F.max(F.when(F.col("base"), F.col("end"))).over(forward),
        "begun": F.min(F.when(F.col("base"), F.col("start"))).over(backward),
    }).filter(F.col("base") | (F.coalesce("ended", F.lit(0)) <= F.col("start")) & (F.coalesce("begun", F.col("end")) >= F.col("end")))
    name = F.get(F.array(*map(F.lit, KINDS)), kind)
    plain = F.lower(F.when(F.col("text").rlike(r"[A-Za-z:]"), F.col("text")).otherwise(_digits(F.col("text"))))
    known = free.select(
        *key, F.when(F.col("base"), name).alias("kind"), "start", "end",
        F.when(F.col("base"), F.array().cast("array<string>")).otherwise(_may_be(F.col("text"))).alias("may"),
        # an identifier of the base is never the same node as a string of unknown kind
        F.concat(F.when(F.col("base"), name).otherwise(F.lit("?")), F.lit(":"), plain).alias("instance"),
        _patterns(F.col("before"), F.col("after")).alias("patterns"))
    return read.select(*key), stage(known, "personal_data_mentions")


def graph(found: DataFrame) -> DataFrame:
    """Edges of patterns and instances: pattern, instance, kind (of the base, 'other' if it can be of none, else null), may.

    Each pair once, however often the corpus repeats it. Only patterns with an
    undecided instance: the others have nothing to find.
    """
    edges = found.select(
        F.explode("patterns").alias("pattern"), "instance",
        F.coalesce("kind", F.when(F.size("may") == 0, F.lit(_OTHER))).alias("kind"), F.array_join("may", " ").alias("may")).distinct()
    useful = edges.groupBy("pattern").agg(F.count(F.when(F.col("kind").isNull(), 1)).alias("open"), F.count("*").alias("all")).filter(
        f"open > 0 and all >= {SUPPORT}").select("pattern")
    return stage(edges.join(useful, "pattern", "left_semi"), "personal_data_graph")


def pattern_scores(edges: DataFrame, named: DataFrame | None) -> DataFrame:
    """Score of every pattern for every kind: pattern, kind, score, support.

    score = (identifiers of the kind) / (all decided ones + 0.1 * undecided ones + 1),
    each with its own belief (support counts them plainly); ``named`` (instance, named, belief) are those that
    earlier rounds have decided.
    """
    if named is None:
        labelled = edges.withColumns({"label": F.col("kind"), "belief": F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0)})
    else:
        labelled = edges.join(named, "instance", "left").withColumns({
            "label": F.coalesce("kind", "named"),
            "belief": F.when(F.col("kind").isNotNull(), 1.0).otherwise(F.coalesce("belief", F.lit(0.0)))})
    sums = labelled.groupBy("pattern").agg(
        F.sum("belief").alias("decided"), F.sum(F.when(F.col("label").isNull(), 1).otherwise(0)).alias("open"),
        *(F.sum(F.when(F.col("label") == k, F.col("belief")).otherwise(0.0)).alias(k) for k in KINDS),
        *(F.sum(F.when(F.col("label") == k, 1).otherwise(0)).alias(f"n_{k}") for k in KINDS))
    all_of = F.col("decided") + UNDECIDED * F.col("open") + 1
    return sums.select("pattern", F.inline(F.array(*(
        F.struct(F.lit(k).alias("kind"), (F.col(k) / all_of).alias("score"), F.col(f"n_{k}").alias("support")) for k in KINDS))))


def discover(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame | None:
    """Identifiers that believed patterns name: instance, named (kind), belief; None where there are none.

    Each round scores the patterns by what is known, believes those of enough support and
    score, and gives an undecided instance the score 1 - product of (1 - score) over its
    believed patterns, for kinds that it may be of; the best kind wins, at equal scores the
    first by name. Rounds are written tables.
    """
    open_ = edges.filter(F.col("kind").isNull()).select("pattern", "instance", "may")
    named = None
    for _ in range(rounds):
        believed = pattern_scores(edges, named).filter((F.col("support") >= SUPPORT) & (F.col("score") >= BELIEVED)).select(
            "pattern", F.col("kind").alias("named"), "score")
        hits = open_.join(believed, "pattern").filter(F.array_contains(F.split("may", " "), F.col("named")))
        beliefs = hits.groupBy("instance", "named").agg((1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("belief"))
        best = beliefs.groupBy("instance").agg(F.min(F.struct((-F.col("belief")).alias("b"), F.col("named"))).alias("best")).select(
            "instance", F.col("best.named").alias("named"), (-F.col("best.b")).alias("belief")).filter(F.col("belief") >= BELIEVED)
        now = stage(best, "personal_data_named")
        if now.isEmpty():
            return named
        if named is not None and now.count() == named.count() and now.join(named, ["instance", "named"], "left_anti").isEmpty():
            return now
        named = now
    return named


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end, base), by start, then kind.

    Places are code points, end exclusive. ``base`` spans match a pattern and its check;
    the others were discovered by the contexts that the corpus gives to the former.

    Nulls and empty texts have no spans. Repeated rows give equal rows and count once for
    the patterns. A null id is an id like any other. An empty table gives none. Other
    columns of ``docs`` are not read. A text of any length is read once per pattern;
    its matches are put in place by a window over that document alone. What piles up on one
    pattern or identifier is a partial sum; joins are plain joins of a side with unique
    keys, which adaptive execution splits.
    """
    read, found = mentions(docs, id_col, text_col)
    named = discover(graph(found), rounds)
    spans = found.filter(F.col("kind").isNotNull()).select("doc_id", "mark", "kind", "start", "end", F.lit(True).alias("base"))
    if named is not None:
        more = found.filter(F.col("kind").isNull()).join(named, "instance").select(
            "doc_id", "mark", F.col("named").alias("kind"), "start", "end", F.lit(False).alias("base"))
        spans = spans.unionByName(more)
    place = reduce(lambda c, k: c.when(F.col("kind") == KINDS[k], k), range(1, len(KINDS)), F.when(F.col("kind") == KINDS[0], 0))
    lists = spans.groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "end", "kind", "base"))).alias("spans"))
    lists = lists.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.transform(
        "spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))
    ).alias("spans"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    return read.join(lists, same, "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data_report(docs: DataFrame) -> DataFrame:
    """The operator's rows as counts and digest of the base, all spans as text, and the number of discovered ones."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return find_personal_data(docs).select(
        "doc_id", *map(count, KINDS), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_found"))
