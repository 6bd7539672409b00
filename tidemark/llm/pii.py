r"""Personal data by patterns and bootstrapped contexts (native: DataFrame functions only).

*Base spans* are matches of fixed patterns per kind (email, ip, card, phone), leftmost and without
overlap, checked by their digits.  The written patterns below match the same strings as the plain ones
but in linear time and without recursion: a run is entered at its start only, and separators that stand
between two characters of a run are first replaced by one control character, which keeps offsets.

*Bootstrapping* then looks for identifiers that no pattern knows.  An occurrence is a base span, or a run of
tokens with marks (a digit, an at-sign, "(at)" or "[at]") one space apart, or a single such token where no run
stands; its lexical pattern is the two words before it.  The distinct (pattern, instance) pairs are a graph.
Each round scores a pattern for a kind by the share of its instances that are known as that kind (``support``
of them at least), and an instance by the noisy-or of its patterns.  Instances at or above ``confidence``
become known and all their occurrences are added spans.  Base spans stay.

A text of n matches takes about n ** 1.5 small steps: running sums and maxima go over blocks of about the root
of n, and contexts are put together from the pieces between the matches, never cut out of the whole text.

Cases: null text is empty.  Rows are told apart by a key of their own, so ids may repeat or be null.
Texts without matches have empty spans; very long texts are matched whole, and what
is longer than ``MAX_CHARS`` is no identifier (base spans have no such limit).  Of two kinds with one score the first listed wins.  An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import load, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
_L, _D = r"A-Za-z0-9._%+\x01-", r"A-Za-z0-9-"
EMAIL = rf"(?:\G|(?<![{_L}]))[{_L}]++@[{_D}]++\x01[{_D}\x01]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
CARD = r"(?<![0-9\x01])[0-9\x01]{16,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token that may be an identifier: it has a mark.
_T = r"[^\s\x22'<>,;=]"
TOKEN = rf"(?<!{_T}){_T}*(?:[0-9@]|[(\[][Aa][Tt][)\]]){_T}*"
#: Spaces inside a run of such tokens: a digit on both sides, 16 characters away at most.
GLUE = rf"(?<=[0-9]{_T}{{0,16}})\x20(?={_T}{{0,16}}[0-9])"
#: Characters of an identifier that is no base span.
MIN_CHARS, MAX_CHARS = 4, 64
#: Characters before an occurrence in which its two words are looked for.
LEFT_CHARS = 60
SUPPORT, CONFIDENCE, ROUNDS = 5, 0.8, 2

_SPAN = "struct<kind:int,start:int,stop:int>"
_EMPTY = f"cast(array() as array<{_SPAN}>)"
_EMPTY_FOUND = "cast(array() as array<struct<kind:int,start:int,stop:int,surface:string,left:string>>)"
_FAR = 2**31 - 1


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, also where ``body`` uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, zero: int, op) -> Column:
    """Running folds, each element included, of a filled array of int; block by block."""
    def fold(a: Column) -> Column:
        return F.aggregate(a, F.array(F.lit(zero)), lambda acc, x: F.concat(acc, F.array(op(F.element_at(acc, -1), x))))

    def in_blocks(a: Column, k: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / k).cast("int")), lambda b: fold(F.slice(a, b * k + 1, k)))
        return _let(blocks, lambda w: _let(fold(F.transform(w, lambda x: F.element_at(x, -1))), lambda before: F.flatten(
            F.transform(w, lambda x, i: F.transform(F.slice(x, 2, F.size(x) - 1), lambda v: op(before[i], v))))))

    return _let(values, lambda a: _let(F.ceil(F.sqrt(F.size(a))).cast("int"), lambda k: in_blocks(a, k)))


def _found(text: Column, pattern: str, kind: int, ok) -> Column:
    """Matches of ``pattern`` that pass ``ok``: offsets in code points, surface, and the characters to the left."""
    def tail(x: Column) -> Column:
        return F.coalesce(F.substring(x, -LEFT_CHARS, LEFT_CHARS), F.lit(""))

    def spans(piece: Column, hit: Column) -> Column:
        ends = _running(F.transform(hit, lambda x, i: F.length(piece[i]) + F.length(x)), 0, lambda a, b: a + b)

        def span(x: Column, i: Column, end: Column) -> Column:
            left = tail(F.concat(tail(F.get(hit, i - 2)), tail(F.get(piece, i - 1)), tail(F.get(hit, i - 1)), tail(piece[i])))
            return F.struct(F.lit(kind).alias("kind"), (end - F.length(x)).alias("start"), end.alias("stop"), x.alias("surface"), left.alias("left"))

        return F.filter(_let(ends, lambda e: F.transform(hit, lambda x, i: span(x, i, e[i]))), lambda o: ok(o["surface"]))

    found = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hit: F.when(
        F.size(hit) > 0, _let(F.split(text, pattern, -1), lambda piece: spans(piece, hit))).otherwise(F.expr(_EMPTY_FOUND)))
    return found


def _apart(found: Column, others: Column) -> Column:
    """Those of ``found`` that share no character with one of ``others``: a merge by start."""
    def merged(both: Column) -> Column:
        mine = lambda o: o["own"]                                                                            # noqa: E731
        seen = _running(F.transform(both, lambda o: F.when(mine(o), F.lit(-1)).otherwise(o["span"]["stop"])), -1, F.greatest)
        ahead = F.reverse(_running(F.reverse(F.transform(both, lambda o: F.when(mine(o), F.lit(_FAR)).otherwise(o["span"]["start"]))), _FAR, F.least))
        return _let(seen, lambda s: _let(ahead, lambda h: F.transform(F.filter(
            F.transform(both, lambda o, i: F.struct(o["span"].alias("span"), (mine(o) & (s[i] <= o["span"]["start"]) & (h[i] >= o["span"]["stop"])).alias("keep"))),
            lambda o: o["keep"]), lambda o: o["span"])))

    def tagged(spans: Column, own: bool) -> Column:
        return F.transform(spans, lambda o: F.struct(o["start"].alias("start"), F.lit(own).alias("own"), o.alias("span")))

    return _let(found, lambda f: _let(others, lambda b: F.when((F.size(f) == 0) | (F.size(b) == 0), f).otherwise(
        _let(F.array_sort(F.concat(tagged(f, True), tagged(b, False))), merged))))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    d = F.reverse(_digits(x))

    def add(total, i):
        v = F.substr(d, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return total + F.when(v > 9, v - 9).otherwise(v)

    return (F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0)


def base_spans(text: Column) -> Column:
    """Spans of a non-null text by kind, then start: kind, start, stop, surface, left."""
    clean = F.translate(text, "\x01", "\x02")
    dots = F.regexp_replace(clean, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", "\x01")
    joined = F.regexp_replace(clean, r"(?<=[0-9])[\x20-](?=[0-9])", "\x01")
    none = F.expr(_EMPTY_FOUND)
    email = F.when(F.contains(text, F.lit("@")), _found(dots, EMAIL, 0, lambda x: F.lit(True))).otherwise(none)
    ip = F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), _found(text, IP, 1, lambda x: F.rlike(x, F.lit(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")))).otherwise(none)
    card = F.when(F.rlike(text, F.lit(r"[0-9][0-9\x20-]{14,}+")), _found(
        joined, CARD, 2, lambda x: F.when(F.length(_digits(x)).between(16, 19), _luhn(x)).otherwise(F.lit(False)))).otherwise(none)
    phone = F.when(F.rlike(text, F.lit(r"\+[0-9]")), _found(text, PHONE, 3, lambda x: F.length(_digits(x)).between(8, 15))).otherwise(none)
    return F.concat(email, ip, card, phone)


def with_occurrences(rows: DataFrame) -> DataFrame:
    """``rows`` (non-null ``text`` and its ``base`` spans) with ``seen``: kind (null: unknown), start, stop, instance, pattern."""
    def sized(x: Column) -> Column:
        return F.length(x).between(MIN_CHARS, MAX_CHARS)

    def full(s):
        surface = F.translate(s["surface"], "\x01", " ")
        trimmed = F.when(s["kind"].isin(0), F.translate(s["surface"], "\x01", ".")).otherwise(F.regexp_replace(surface, r"[.!?:)]++$", ""))
        words = F.regexp_extract(F.translate(s["left"], "\x01", " "), r"(\S+\s+)?\S+\s*$", 0)
        return F.struct(F.when(s["kind"] >= 0, s["kind"]).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(trimmed)).alias("stop"),
                        F.lower(trimmed).alias("instance"), F.translate(F.lower(words), "123456789", "000000000").alias("pattern"))

    none, marked = F.expr(_EMPTY_FOUND), F.rlike("text", F.lit(r"[0-9@]|(?i)[(\[]at[)\]]"))
    clean = F.translate("text", "\x01", "\x02")
    # Column by column: as one expression, the lambdas would be nested too deep for the analyser.
    rows = rows.withColumn("_tokens", F.when(marked, _found(clean, TOKEN, -1, sized)).otherwise(none))
    rows = rows.withColumn("_glued", F.when(marked, F.regexp_replace(clean, GLUE, "\x01")).otherwise(F.lit("")))
    rows = rows.withColumn("_runs", F.when(F.contains("_glued", F.lit("\x01")), _found(F.col("_glued"), TOKEN, -1, lambda x: F.contains(x, F.lit("\x01")) & sized(x))).otherwise(none))
    rows = rows.withColumn("_runs", _apart(F.col("_runs"), F.col("base")))
    rows = rows.withColumn("_fixed", F.concat("base", "_runs"))
    rows = rows.withColumn("_seen", F.concat("_fixed", _apart(F.col("_tokens"), F.col("_fixed"))))
    return rows.withColumn("seen", F.filter(F.transform("_seen", full), lambda o: (F.length(o["pattern"]) > 0) & (o["stop"] > o["start"]))) \
        .drop("_tokens", "_glued", "_runs", "_fixed", "_seen")


def discover(occurrences: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """instance, kind, score of the identifiers that patterns reveal.  ``occurrences``: kind, instance, pattern."""
    edges = written(occurrences.groupBy("pattern", "instance").agg(F.min("kind").alias("kind")), "pii_edges")
    known = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    found = None
    for _ in range(rounds):
        # Share of each pattern's instances that are known as a kind.
        total = edges.groupBy("pattern").agg(F.count("*").alias("total"))
        share = edges.select("pattern", "instance").join(known.select("instance", F.col("kind").alias("k")), "instance") \
            .groupBy("pattern", "k").agg(F.count("*").alias("n")).where(F.col("n") >= support) \
            .join(total, "pattern").select("pattern", "k", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= confidence / 2)
        # Noisy-or over the patterns of an unknown instance.
        scored = edges.where("kind is null").join(share, "pattern").groupBy("instance", "k") \
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("share"), F.lit(1e-9)))))).alias("score")).where(F.col("score") >= confidence)
        best = Window.partitionBy("instance").orderBy(F.col("score").desc(), "k")
        found = written(scored.withColumn("nth", F.row_number().over(best)).where("nth = 1")
                        .select("instance", F.col("k").alias("kind"), "score"), "pii_found")
        if found.isEmpty():
            break
        known = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0)).unionByName(found)
    return found


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
             confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, base and added (arrays of kind number, start, stop in code points)."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")) \
        .withColumn("base", base_spans(F.col("text")))
    # Written once: the keys are then fixed, and the texts are read and matched in one pass.
    bare = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    rows = written(with_occurrences(rows).select("key", "id", bare.alias("base"), "seen"), "pii_rows")
    seen = rows.select("key", F.explode("seen").alias("o")).select("key", "o.*")
    found = discover(seen, support, confidence, rounds)
    if found.isEmpty():
        return rows.select("id", "base", F.expr(_EMPTY).alias("added"))
    added = seen.where("kind is null").drop("kind").join(found.select("instance", "kind"), "instance").groupBy("key") \
        .agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("added"))
    return rows.join(added, "key", "left").select("id", "base", F.coalesce("added", F.expr(_EMPTY)).alias("added"))


def mask(text: Column, spans: Column, name: str = "[{}]") -> Column:
    """``text`` with each span (sorted by start, apart) replaced by the name of its kind."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    names = F.array(*[F.lit(name.format(k)) for k in KINDS])
    done = F.aggregate(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))), zero,
                       lambda acc, s: F.struct(s["stop"].alias("at"), F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), names[s["kind"]]).alias("out")))
    return F.concat(done["out"], F.substr(text, done["at"] + 1, F.length(text)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))))


def op3(spark, sf_dir: str) -> DataFrame:
    """Every document with its personal data."""
    out = find_pii(load(spark, sf_dir, "documents"))

    def count(k: int) -> Column:
        # A second parameter of the lambda, even one with a default, would be the position in the array.
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return out.select(F.col("id").alias("doc_id"), *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                      _listed(F.concat("base", "added")).alias("spans"))


def brute_force(text: str | None) -> list[tuple[str, int, int]]:
    """The base spans by the plain patterns (for tests)."""
    import re
    t, out = text or "", []

    def luhn(d):
        return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    checks = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
              ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
              ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
              ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15))
    for kind, pattern, ok in checks:
        out += [(kind, *m.span()) for m in re.finditer(pattern, t) if ok(m[0])]
    return out
