"""Operator 1: personal data by bootstrapped contextual extraction.

1. Seeds: emails, IP addresses, card and phone numbers are found in every whole text by
   fixed expressions; spans come from the lengths of the matches and of the text between
   them.  Candidates are the other tokens of at least three digits, runs of digit groups
   (3 to 19 digits) joined by spaces, dots, hyphens or brackets, tokens with an @, and
   addresses written with ``at`` and ``dot``.
2. Every seed and candidate carries its lexical patterns, in lower case and with digits
   masked: two words left, one left, one right, one on both sides, and two left of which
   the nearer is masked to its shape.  (pattern, instance) pairs are counted over all documents.
3. The graph is scored in ``rounds``: a pattern's confidence for a kind is the mean score
   of its distinct instances (seeds score 1 for their kind; patterns of one exact word
   count half an instance more), an instance's score is the noisy-or of its confident
   patterns of kinds whose shape it has.  A pattern needs ``support`` distinct seeds.
4. Occurrences of unseen instances beside a pattern of confidence ``confident`` or more
   join the spans, under the pattern's kind; of nested ones the longest.  Base spans always stay.

DataFrame functions only; the expressions are written so that they never rescan a run of
characters.  A null text is an empty one.  Repeated rows get the same spans; instances are
counted distinct, so copies do not raise a pattern.  Extra columns do not matter.  An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_side, staged

KINDS = ["email", "ip", "card", "phone"]
# Fixed expressions of the contract; possessive and anchored at run starts, which changes no match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = r"(?<!\S)[^\s0-9]*+[0-9][^\s0-9]*+[0-9][^\s0-9]*+[0-9]\S*+"
ATOM = r"(?:\([0-9]++\)|[0-9]++)"
RUN = rf"(?<![^\s\[{{\"'<*#:=(])\+?+{ATOM}(?:(?:[.-]?\x20[.-]?|[.-]{{0,2}}){ATOM})*+\S*+"
AT, DOT = (rf"(?:\x20(?i:{w})\x20|\x20?[(\[](?i:{w})[)\]]\x20?)" for w in ("at", "dot"))
MAIL = (r"(?<!\S)[^\s@]++(?:(?<![A-Za-z0-9._%+-])@|@(?![A-Za-z0-9-]++\.[A-Za-z0-9-]))\S++"
        rf"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:(?:{DOT}|\.)[A-Za-z0-9-]++)++(?<=[A-Za-z])")
EDGES = "([{\"'<*#$%&!|.,:;?)]}>`~=_-/\\"
PART = r"(?=[0-9])0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[1-9])?"
BLOCK = 256
CONTEXT_CHARS = 64


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a name inside ``use``, not a copy in each place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(xs: Column) -> Column:
    """Prefix sums of an int array, in blocks so that the work stays near linear."""
    def sums(ys: Column) -> Column:
        return F.aggregate(ys, F.array().cast("array<int>"), lambda a, y: F.concat(
            a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + y)))

    def cut(ys: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(ys) - 1) / BLOCK).cast("int")), lambda b: F.slice(ys, b * BLOCK + 1, F.lit(BLOCK)))

    def joined(blocks: Column) -> Column:
        totals = sums(F.transform(blocks, lambda ys: F.aggregate(ys, F.lit(0), lambda a, y: a + y)))
        return _bound(totals, lambda t: F.flatten(F.transform(blocks, lambda ys, b: _bound(
            F.when(b > 0, F.element_at(t, F.greatest(b, F.lit(1)))).otherwise(0), lambda before: F.transform(sums(ys), lambda s: s + before)))))

    return _bound(xs, lambda ys: _bound(cut(ys), joined))


def _contexts(before: Column, after: Column) -> Column:
    """The patterns of a match between ``before`` and ``after``, a sign for their form first."""
    def masked(words: Column) -> Column:
        return F.translate(F.trim(F.regexp_replace(words, r"\s+", " ")), "0123456789", "0" * 10)

    tail = F.lower(F.substring(before, -CONTEXT_CHARS, CONTEXT_CHARS))
    two = masked(F.regexp_extract(tail, r"(?:(\S+)\s++)?+(\S+)\s*$", 0))
    right = masked(F.regexp_extract(F.lower(F.substring(after, 1, CONTEXT_CHARS)), r"^\S*+\s++(\S++)", 1))

    def forms(x: Column) -> Column:
        first, one = F.substring_index(x["two"], " ", 1), F.substring_index(x["two"], " ", -1)
        shape = F.regexp_replace(F.regexp_replace(one, r"\p{L}+", "a"), "0+", "0")
        return F.array(F.when(one != "", F.concat(F.lit("2 "), x["two"])), F.when(one != "", F.concat(F.lit("< "), one)),
                       F.when(x["right"] != "", F.concat(F.lit("> "), x["right"])),
                       F.when((one != "") & (x["right"] != ""), F.concat(F.lit("= "), one, F.lit(" "), x["right"])),
                       F.when(x["two"].contains(" "), F.concat(F.lit("~ "), first, F.lit(" "), shape)))

    once = F.transform(F.array(F.struct(two.alias("two"), right.alias("right"))), forms)    # words are taken out once
    return F.array_compact(F.flatten(once))


def _shaped(k: Column, inst: Column) -> Column:
    """Whether an unseen instance may be of kind ``k`` by its characters."""
    digits = F.length(F.regexp_replace(inst, "[^0-9]", ""))
    return F.when(k == 0, inst.rlike(r"[@\p{L}]")).when(k == 1, inst.rlike(r"[.:][^.:]*+[.:]") & (digits >= 3)) \
        .when(k == 2, (digits >= 8) & ~inst.contains("@")).otherwise(digits.between(3, 15) & ~inst.contains("@"))


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")
    if kind == "card":
        def step(acc, i):
            d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
            return acc + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

        luhn = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0
        return F.when(F.length(digits).between(13, 19), luhn).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _spans(found: str, gaps: str, kind: int) -> Column:
    """array<struct<k, s, e, ctx, inst>> of the matches in ``found``, ``gaps`` being the text around
    them; words of the neighbouring matches belong to the patterns in ``ctx``."""
    f, g = F.col(found), F.col(gaps)
    ends = running_sums(F.transform(f, lambda m, i: F.length(m) + F.length(F.get(g, i))))

    def near(xs: Column, i: Column, chars: int) -> Column:
        x = F.when(i >= 0, F.get(xs, i))
        return F.coalesce(F.substring(x, -chars, chars) if chars > 0 else F.substring(x, 1, -chars), F.lit(""))

    def around(i: Column) -> Column:
        c = CONTEXT_CHARS
        return _contexts(F.concat(near(f, i - 2, c), near(g, i - 1, c), near(f, i - 1, c), near(g, i, c)),
                         F.concat(near(g, i + 1, -c), near(f, i + 1, -c), near(g, i + 2, -c)))

    each = F.transform(F.arrays_zip(f.alias("m"), ends.alias("e")), lambda x, i: F.struct(
        F.lit(kind).alias("k"), (x["e"] - F.length(x["m"])).alias("s"), x["e"].alias("e"),
        around(i).alias("ctx"), x["m"].alias("inst")))
    none = F.array().cast("array<struct<k:int,s:int,e:int,ctx:array<string>,inst:string>>")
    return F.when(F.size(f) > 0, each).otherwise(none)


def base_and_candidates(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``base`` (valid base spans, by kind and start) and ``cands`` (whatever they
    overlap) in place of ``text``."""
    rest = [c for c in rows.columns if c != text]
    step = rows.withColumn(text, F.coalesce(text, F.lit("")))
    names = {k: PATTERNS[k] for k in KINDS} | {"cand": CANDIDATE, "run": RUN, "mail": MAIL}
    step = step.select("*", *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in names.items()])
    step = step.select(*rest, *[f"m_{k}" for k in names], *[
        F.when(F.size(f"m_{k}") > 0, F.split(text, p, -1)).alias(f"g_{k}") for k, p in names.items()])

    def valid_spans(i: int, k: str) -> Column:
        return F.filter(_spans(f"m_{k}", f"g_{k}", i), lambda x: _valid(k, x["inst"]))

    valid = [valid_spans(i, k) for i, k in enumerate(KINDS)]
    step = step.select(*rest, F.concat(*valid).alias("base"),
                       *[_spans(f"m_{k}", f"g_{k}", -1).alias(k) for k in ("cand", "run", "mail")])

    def trimmed(x: Column, edges: str) -> Column:
        left = F.ltrim(x["inst"], F.lit(edges))
        both = F.rtrim(left, F.lit(EDGES))
        start = x["s"] + F.length(x["inst"]) - F.length(left)
        return F.struct(x["k"].alias("k"), start.alias("s"), (start + F.length(both)).alias("e"),
                        x["ctx"].alias("ctx"), both.alias("inst"))

    def a_run(x: Column) -> Column:                     # longer ones are several numbers: their tokens stand alone
        return x["inst"].contains(" ") & F.length(F.regexp_replace(x["inst"], "[^0-9]", "")).between(3, 19)

    def wanted(x: Column) -> Column:
        return (F.length(x["inst"]) >= 3) & (F.size(x["ctx"]) > 0)

    def of(kind: int, xs: Column) -> Column:
        return F.transform(F.filter(xs, wanted), lambda x: x.withField("k", F.lit(kind)))

    cands = F.concat(of(TOKEN, F.transform("cand", lambda x: trimmed(x, EDGES))), of(DIGITS, F.filter(F.transform("run", lambda x: trimmed(x, " ")), a_run)),
                     of(ADDRESS, F.transform("mail", lambda x: trimmed(x, EDGES))))
    return step.select(*rest, "base", cands.alias("cands"))


TOKEN, DIGITS, ADDRESS = -1, -2, -3          # what a candidate was found as, in place of its kind


def _free_of(rows: DataFrame, blocks: Column) -> DataFrame:
    """The rows (rid, s, e, ...) that no row with ``blocks`` overlaps, and those rows, by two
    running extremes along each text: the ends of those that start before, the starts of those after."""
    up, down = (Window.partitionBy("rid").orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.col("s"), F.desc("s")))
    rows = rows.withColumns({"__end": F.max(F.when(blocks, F.col("e"))).over(up), "__start": F.min(F.when(blocks, F.col("s"))).over(down)})
    clear = (F.coalesce("__end", F.lit(0)) <= F.col("s")) & F.coalesce(F.col("__start") >= F.col("e"), F.lit(True))
    return rows.where(blocks | clear).drop("__end", "__start")


def candidates(rows: DataFrame) -> DataFrame:
    """rid, s, e, x: the candidates that overlap no base span; tokens also no run of digits kept."""
    found = rows.where(F.size("cands") > 0)
    every = found.select("rid", F.explode("cands").alias("x")).unionByName(
        found.select("rid", F.explode("base").alias("x"))).select("rid", "x.s", "x.e", "x")
    kept = _free_of(every, F.col("x.k") >= 0).where("x.k < 0")
    return _free_of(kept.where(F.col("x.k") != ADDRESS), F.col("x.k") == DIGITS).unionByName(kept.where(F.col("x.k") == ADDRESS))


def score_graph(found: DataFrame, support: int = 3, confident: float = 0.75, rounds: int = 3) -> DataFrame:
    """ctx, k, inst, score: the unseen instances behind confident patterns.  ``found``:
    occurrences (ctx, k or -1, inst)."""
    edges = staged(found.groupBy("ctx", "inst", "k").agg(F.count(F.lit(1)).alias("n")), "pii-edges")
    seeds = edges.where("k >= 0").select("inst", "k").distinct().withColumn("score", F.lit(1.0))
    kinds = edges.where("k >= 0").groupBy("ctx", "k").agg(F.count_distinct("inst").alias("seeds")) \
        .where(F.col("seeds") >= support)                    # the patterns that seeds induce
    kinds = staged(kinds, "pii-patterns")
    members = staged(edges.select("ctx", "inst").distinct().join(kinds.select("ctx").distinct(), "ctx", "left_semi"), "pii-members")
    total = members.groupBy("ctx").agg(F.count(F.lit(1)).alias("total"))
    general = F.when(F.substring("ctx", 1, 1).isin("<", ">", "~"), 0.5).otherwise(0.0)
    scores, learned = seeds, None
    for _ in range(rounds):
        got = members.join(scores, "inst").groupBy("ctx", "k").agg(F.sum("score").alias("mass"))
        patterns = kinds.join(got, ["ctx", "k"]).join(total, "ctx").select(
            "ctx", "k", (F.col("mass") / (F.col("total") + general)).alias("conf")).where(F.col("conf") >= confident)
        # noisy-or over an instance's patterns; the logarithm keeps the product a sum
        miss = F.sum(F.log(F.lit(1.0) - F.least(F.col("conf"), F.lit(0.999999))))
        learned = members.join(patterns, "ctx").where(_shaped(F.col("k"), F.col("inst"))).groupBy("inst", "k").agg((F.lit(1.0) - F.exp(miss)).alias("score"))
        learned = staged(learned.join(seeds.select("inst").distinct(), "inst", "left_anti"), "pii-scores")
        scores = seeds.unionByName(learned)
    best = learned.groupBy("inst").agg(F.max(F.struct("score", (-F.col("k")).alias("k"))).alias("b")) \
        .select("inst", (-F.col("b.k")).alias("k"), F.col("b.score").alias("score"))
    return staged(members.join(patterns, "ctx").join(best, ["inst", "k"]).select("ctx", "inst", "k", "score"), "pii-found")


def extract(docs: DataFrame, *, support: int = 3, confident: float = 0.75, rounds: int = 3) -> DataFrame:
    """doc_id, base and spans (arrays of struct<k, s, e, ctx, inst>, by kind and start; k is
    the place in ``KINDS``) for every document."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), "text")
    rows = staged(base_and_candidates(rows), "pii-rows")
    seeds = rows.select(F.explode("base").alias("x")).select(F.explode("x.ctx").alias("ctx"), "x.k", "x.inst")
    cands = staged(candidates(rows), "pii-candidates").select("rid", "x", F.explode("x.ctx").alias("c"))
    found = score_graph(seeds.unionByName(cands.select(F.col("c").alias("ctx"), F.lit(-1).alias("k"), "x.inst")), support, confident, rounds)
    new = cands.join(small_side(found), (F.col("c") == F.col("ctx")) & (F.col("x.inst") == F.col("inst"))) \
        .groupBy("rid", F.col("k").alias("k"), F.col("x.s").alias("s"), F.col("x.e").alias("e")) \
        .agg(F.min("x.ctx").alias("ctx"), F.min("x.inst").alias("inst"))
    # of nested ones the longest: nothing that starts before reaches as far, nothing that starts there further
    before = F.max("e").over(Window.partitionBy("rid").orderBy("s").rangeBetween(Window.unboundedPreceding, -1))
    here = F.max("e").over(Window.partitionBy("rid", "s"))
    new = new.withColumns({"__b": before, "__h": here}).where((F.coalesce("__b", F.lit(0)) < F.col("e")) & (F.col("__h") <= F.col("e")))
    new = new.groupBy("rid").agg(F.collect_list(F.struct("k", "s", "e", "ctx", "inst")).alias("new"))
    return rows.join(new, "rid", "left").select(
        "doc_id", F.array_sort("base").alias("base"),
        F.array_sort(F.when(F.col("new").isNull(), F.col("base")).otherwise(F.concat("base", "new"))).alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, *, support: int = 3, confident: float = 0.75, rounds: int = 3) -> DataFrame:
    """``docs`` with every span replaced by [KIND] (overlapping spans by the first one's) and
    n_chars, where there is such a column, counted anew."""
    keys = [F.xxhash64("text").alias("__k1"), F.xxhash64(F.lit(7), "text", F.length("text")).alias("__k2")]
    texts = docs.where(F.col("text").isNotNull()).select(F.struct(*keys).alias("doc_id"), "text")
    found = extract(texts, support=support, confident=confident, rounds=rounds).where(F.size("spans") > 0)
    found = found.select(F.col("doc_id.*"), F.transform(F.array_sort(F.transform("spans", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k")))), lambda x: x).alias("__spans"))
    found = staged(found.groupBy("__k1", "__k2").agg(F.first("__spans").alias("__spans")), "pii-redactions")
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # a chain of (text so far, end of the last span): a span that starts inside the last one only moves the end
    pieces = F.aggregate("__spans", F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at")), lambda a, x: F.struct(
        F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(
            F.substring("text", a["at"] + 1, x["s"] - a["at"]), F.element_at(kinds, x["k"] + 1)))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], x["e"]).alias("at")))
    joined = docs.select("*", *keys).join(small_side(found, 20_000), ["__k1", "__k2"], "left").withColumn("__p", pieces)
    clean = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.concat(
        F.array_join("__p.out", ""), F.substring("text", F.col("__p.at") + 1, F.length("text"))))
    out = joined.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
