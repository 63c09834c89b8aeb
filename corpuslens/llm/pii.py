"""PII: overlapping candidates, boosted trees on format and context, calibrated thresholds; column expressions only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.tables import documents, packed_rows, query

KINDS = ["email", "ip", "card", "phone"]
#: The leftmost non-overlapping matches of these are those of the plain patterns. A match can only begin where a run of
#: its characters begins or where the last match ended; saying so, and never giving characters back, keeps the search
#: linear and without recursion in texts of any length.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_GROUPS = r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}"
#: Generators of further candidates: they would rather propose too much. With each, the marks of which a text with a
#: match holds one at least; looking for them is much cheaper.
WIDE = {
    "email": [
        (r"(?<![\w.%+-])[\w.%+-]{1,64}+\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?[\w-]{1,63}+(?:(?:\.|\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?)[\w-]{1,63}+){1,5}", ["at", "AT"]),
        (r"(?<![\w.%+-])[\w.%+-]{1,64}+\x20at\x20[\w-]{1,63}+(?:\x20dot\x20[\w-]{1,63}+){1,4}", [" at "]),
    ],
    "ip": [
        (r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", [":"]),
        (rf"(?<![0-9A-Za-z:])(?:{_GROUPS}::(?:{_GROUPS})?|::{_GROUPS})(?![0-9A-Za-z:])", ["::"]),
        (r"(?<![0-9])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])", ["[.]"]),
    ],
    "card": [(r"(?<![0-9./_])[0-9]{4}(?:[./_][0-9]{4}){2}[./_][0-9]{1,7}(?![0-9./_])", [".", "/", "_"])],
    "phone": [
        (r"(?<![0-9A-Za-z+./-])\(?[0-9]{2,5}\)?[-./\x20]{0,2}[0-9]{2,4}[-./\x20][0-9]{2,4}(?:[-./\x20][0-9]{2,4}){0,3}(?![0-9A-Za-z./-])", ["-", ".", "/", " "]),
    ],
}
#: Kinds whose generators all take a digit.
WITH_DIGIT = ["card", "phone"]
CONTEXT = 24
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|reach|correo|courriel|schreib)",
    "ip": r"(?i)(?:\bip(?:v6)?\b|host|server|addr|client|login)",
    "card": r"(?i)(?:card|visa|master|amex|credit|karte|carte|tarjeta|iban)",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|dial|ring|whatsapp|handy|llam|appel|ruf)",
}
OTHER_CUES = r"(?i)(?:isbn|issn|version|page|order|invoice|total|price|date|year|ratio|score|serial|model|section|doi|no\.?\s*$|[$€£]\s*$)"
FEATURES = ["kind", "n_digits", "n_letters", "n_chars", "n_groups", "longest", "first", "last_group", "dots", "dashes", "slashes", "spaces",
            "round", "square", "colons", "valid", "cue", "other_cue", "year_like", "date_like", "starts_zero", "touches_letter"]
TREES, DEPTH = 10, 4
#: The bounded training table: formats filled with digits by a hash, half with and half without cues around them.
TRAIN_ROWS = 6000
#: Precision that a kind's threshold must have on the calibration quarter of the training table.
PRECISION = 0.995


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Whether a string of digits passes the check: from the right, every second digit doubled, cross sums, mod 10."""
    back = F.reverse(number)

    def add(total: Column, place: Column) -> Column:
        d = F.substring(back, place, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, stop, hit), in code points, stop exclusive.

    Positions are running sums over what lies between the matches and the matches themselves.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"))
    empty = F.array().cast("array<struct<start:int,stop:int,hit:string>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        stop = start + F.char_length(pair["hit"])
        return F.struct(stop.alias("at"), F.array_append(state["found"], F.struct(start.alias("start"), stop.alias("stop"), pair["hit"].alias("hit"))).alias("found"))

    return F.aggregate(pairs, begin, step, lambda state: state["found"])


def _guarded(text: Column, found: Column, marks: list[str]) -> Column:
    """`found` where the text holds one of the marks, without which nothing can be found."""
    has = reduce(lambda a, b: a | b, [text.contains(m) for m in marks])
    return F.when(has, found).otherwise(F.array().cast("array<struct<start:int,stop:int,hit:string>>"))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the plain patterns by kind; matches that fail their check are left out, not tried again."""
    n = lambda x: F.length(digits(x["hit"]))
    parts_ok = lambda x: F.forall(F.split(x["hit"], r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")) <= 3) & F.forall(
        F.split(x["hit"], r"\."), lambda p: F.coalesce(p.try_cast("decimal(38,0)"), F.lit(0)) <= 255)
    return {
        "email": _guarded(text, matches(text, EMAIL), ["@"]),
        "ip": F.filter(_guarded(text, matches(text, IP), ["."]), parts_ok),
        "card": F.filter(matches(text, CARD), lambda x: passes_luhn(digits(x["hit"]))),
        "phone": F.filter(_guarded(text, matches(text, PHONE), ["+"]), lambda x: (n(x) >= 9) & (n(x) <= 15)),
    }


def features(kind: Column, hit: Column, before: Column, after: Column) -> Column:
    """The numbers that the trees look at: format of the candidate and words and characters around it."""
    d, groups = digits(hit), F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    count = lambda p: F.length(F.regexp_replace(hit, p, ""))
    cue = lambda pattern: before.rlike(pattern)
    of_kind = reduce(lambda rest, k: F.when(kind == KINDS.index(k), cue(CUES[k])).otherwise(rest), KINDS, F.lit(False))
    parts = F.split(hit, r"\[?\.\]?|:")
    valid = F.when(kind == 2, (F.length(d) >= 13) & (F.length(d) <= 19) & passes_luhn(F.when(d == "", "1").otherwise(d))).when(
        (kind == 1) & ~hit.contains(":"), F.forall(parts, lambda p: F.coalesce(p.try_cast("int"), F.lit(999)) <= 255)
    ).when((kind == 1) & hit.contains("::"), F.size(F.filter(parts, lambda p: p != "")) <= 7).when(
        kind == 1, (F.size(parts) == 8) & hit.rlike("[a-fA-F]")).when(kind == 3, (F.length(d) >= 9) & (F.length(d) <= 15)).otherwise(
        hit.rlike(r"(?i)(?:com|org|net|edu|de|fr|es|io|uk|info)$"))
    values = {
        "kind": kind, "n_digits": F.length(d), "n_letters": count("[^A-Za-z]"), "n_chars": F.char_length(hit),
        "n_groups": F.size(groups), "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "first": F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)),
        "last_group": F.coalesce(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(0)),
        "dots": count(r"[^.]"), "dashes": count("[^-]"), "slashes": count("[^/_]"), "spaces": count(r"[^\x20]"),
        "round": count("[^(]"), "square": count(r"[^\[{]"), "colons": count("[^:]"), "valid": valid, "cue": of_kind,
        "other_cue": cue(OTHER_CUES), "year_like": hit.rlike(r"(?:^|[^0-9])(?:19|20)[0-9]{2}(?:$|[^0-9])"),
        "date_like": hit.rlike(r"^(?:[0-9]{1,2}[-./\x20][0-9]{1,2}[-./\x20](?:[0-9]{2}|[0-9]{4})|[0-9]{4}[-./\x20][0-9]{1,2}[-./\x20][0-9]{1,2})$"),
        "starts_zero": hit.rlike(r"^\(?0"), "touches_letter": before.rlike(r"[\p{L}_]$") | after.rlike(r"^[\p{L}_]"),
    }
    return F.struct(*(values[f].cast("double").alias(f) for f in FEATURES))


#: Formats of the training table, D for a digit, H for a hexadecimal one, W for a word. Fixed values.
POSITIVE = {
    "email": ["W (at) W.com", "W[at]W.org", "W.W [at] W [dot] com", "W at W dot com", "W.WDD (at) W-W.de", "W at W dot W dot net", "W{at}W.io"],
    "ip": ["HHHH:HHHH:HHHH:HHHH:HHHH:HHHH:HHHH:HHHH", "aHHH:HH:bHH:HHHH:H:cHHH:HHHH:HHHH", "1DD[.]1DD[.]DD[.]1DD", "DD[.]DD[.]1DD[.]D", "1D[.]D[.]D[.]1D",
           "abcd:cafe:fade:beef:deca:face:feed:bead", "2DDD:dbH::H", "2DDD:HHHH:bHHH::HH", "feH0::HHHH:aHHH:HHHH:HHHH", "::ffff:HHHH:cHHH", "fdHH:HHHH::HHHH:H", "::1"],
    "card": ["4DDD/DDDD/DDDD/DDDD", "5DDD.DDDD.DDDD.DDDD", "4DDD_DDDD_DDDD_DDDD"],
    "phone": ["(DDD) DDD-DDDD", "DDD-DDD-DDDD", "(DDD) DDD.DDDD", "DDD.DDD.DDDD", "(0DD) DDDD-DDDD", "0DD DD DD DD DD", "0DDD/DDD DDDD"],
}
NEGATIVE = {
    "email": ["W at W dot W", "W (at) W.W", "W [at] W.W.W"],
    "ip": ["DD:DD:DD:DD", "HH:HH:HH:HH:HH:HH", "DDD[.]DDD[.]DDD[.]DDD", "D:D:D:D:D", "DDDD:DDDD:DDDD:DDDD", "a::b", "bad::face", "add::HH", "D::D", "DD::DD", "DD:DD::DD"],
    "card": ["DDDD/DDDD/DDDD/DDDD", "DDDD.DDDD.DDDD.DDDD", "DDDD_DDDD_DDDD_D"],
    "phone": ["20DD-DD-DD", "DD.DD.20DD", "DD/DD/19DD", "DDD DDD DDD", "DDDD-DDDD", "DD-DD-DD", "D9-20DD-DDD", "978-DD-DDDD-DDD", "DDD-DD-DDDD",
              "DD DDD DDD", "DDDD DDDD", "20DD-20DD 20DD", "DDD.DDD.DDD", "DDD/DDD/DDD", "DD DD DD", "DDDD.DDDD.DD", "DDD DDD DDDD", "DD DD DD DD DD"],
}


def training_table(spark: SparkSession, rows: int = TRAIN_ROWS) -> DataFrame:
    """`rows` labelled candidates with their surroundings, made from the formats above by hashes of the row number."""
    formats = [F.struct(F.lit(KINDS.index(k)).alias("kind"), F.lit(f).alias("form"), F.lit(label).alias("label"))
               for label, table in ((1.0, POSITIVE), (0.0, NEGATIVE)) for k in KINDS for f in table[k]]
    words = F.array(*(F.lit(w) for w in ["anna", "bob", "mueller", "info", "sales", "garcia", "team", "home", "over", "then"]))
    cues = {0: ["email me ", "contact: "], 1: ["host ", "ip "], 2: ["card ", "visa: "], 3: ["tel ", "call me: "]}
    plain, off = ["the ", "and of ", "was in ", ""], ["isbn ", "version ", "order ", "page ", "date: "]

    def pick(values: list[str], salt: str) -> Column:
        return F.get(F.array(*(F.lit(v) for v in values)), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(values))).cast("int"))

    def char(c: Column, i: Column) -> Column:
        r = F.xxhash64(F.col("id"), i)
        return F.when(c == "D", F.pmod(r, F.lit(10)).cast("string")).when(c == "H", F.lower(F.hex(F.pmod(r, F.lit(16))))).when(
            c == "W", F.get(words, F.pmod(r, F.lit(10)).cast("int"))).otherwise(c)

    table = spark.range(rows).select("id", F.get(F.array(*formats), F.pmod(F.xxhash64("id"), F.lit(len(formats))).cast("int")).alias("f"))
    table = table.select("id", F.col("f.kind").alias("kind"), F.col("f.label").alias("label"),
                         F.array_join(F.transform(F.split(F.col("f.form"), ""), char), "").alias("raw"))
    # Positive cards get the last digit that makes them pass.
    fixed = reduce(lambda rest, c: F.when(passes_luhn(digits(F.concat(F.expr("substring(raw, 1, length(raw) - 1)"), F.lit(c)))), F.concat(F.expr("substring(raw, 1, length(raw) - 1)"), F.lit(c))).otherwise(rest), "0123456789", F.col("raw"))
    cue = reduce(lambda rest, k: F.when(F.col("kind") == k, pick(cues[k], "cue")).otherwise(rest), cues, F.lit(""))
    turn = F.pmod(F.xxhash64("id", F.lit("turn")), F.lit(10))
    before = F.when(F.col("label") == 1, F.when(turn < 5, cue).otherwise(pick(plain, "plain"))).otherwise(
        F.when(turn < 3, pick(off, "off")).when(turn < 4, cue).otherwise(pick(plain, "plain")))
    hit = F.when((F.col("kind") == 2) & (F.col("label") == 1), fixed).otherwise(F.col("raw"))
    return table.select("id", "kind", "label", hit.alias("hit"), before.alias("before"), F.lit(" the").alias("after"))


def _tree(node, row: Column) -> Column:
    """A tree of the fitted model as nested conditions on the feature struct."""
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    value = row[FEATURES[split.featureIndex()]]
    return F.when(value <= F.lit(float(split.threshold())), _tree(node.leftChild(), row)).otherwise(_tree(node.rightChild(), row))


class SpanModel:
    """Boosted trees over candidate features and a threshold for each kind."""

    def __init__(self, spark: SparkSession, rows: int = TRAIN_ROWS):
        table = training_table(spark, rows).select("id", "kind", "label", features(F.col("kind"), F.col("hit"), F.col("before"), F.col("after")).alias("x"))
        wide = table.select("id", "label", "x", *(F.col(f"x.{f}").alias(f"f_{f}") for f in FEATURES))
        vectors = VectorAssembler(inputCols=[f"f_{f}" for f in FEATURES], outputCol="features")
        learn = vectors.transform(wide.where(F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(4)) > 0)).select("label", "features").coalesce(1)
        fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.5).fit(learn)
        self._trees = list(zip(fitted.treeWeights, [t._call_java("rootNode") for t in fitted.trees], strict=True))
        self.thresholds = self._calibrate(wide.where(F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(4)) == 0))

    def score(self, row: Column) -> Column:
        """The probability that the trees give to the candidate with these features."""
        margin = reduce(lambda a, b: a + b, [F.lit(float(w)) * _tree(root, row) for w, root in self._trees])
        return 1 / (1 + F.exp(-2 * margin))

    def accepts(self, kind: str) -> Callable[[Column], Column]:
        return lambda c: self.score(c["x"]) >= F.lit(self.thresholds[kind])

    def _calibrate(self, held: DataFrame) -> dict[str, float]:
        """The lowest score of each kind above which the held-out precision is PRECISION; never below one half."""
        bins = held.select(F.col("x.kind").cast("int").alias("kind"), F.floor(self.score(F.col("x")) * 50).alias("bin"), "label")
        counts = bins.groupBy("kind", "bin").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
        found = {}
        for k, kind in enumerate(KINDS):
            good = total = 0.0
            found[kind] = 1.01
            for r in sorted((r for r in counts if r["kind"] == k), key=lambda r: -r["bin"]):
                good, total = good + r["good"], total + r["n"]
                if r["bin"] < 25:
                    break
                if good >= PRECISION * total:
                    found[kind] = r["bin"] / 50
        return found


def _candidates(text: Column, kind: str) -> Column:
    """What the generators of a kind propose, with the surroundings."""
    found = F.concat(*(_guarded(text, matches(text, p), marks) for p, marks in WIDE[kind]))
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), x["hit"].alias("hit"),
        F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT))).alias("before"),
        F.substring(text, x["stop"] + 1, F.lit(CONTEXT)).alias("after"),
    ))


def _featured(kind: int) -> Callable[[Column], Column]:
    return lambda c: F.struct(
        F.lit(kind).alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"),
        features(F.lit(kind), c["hit"], c["before"], c["after"]).alias("x"),
    )


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def find_spans(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """`docs` with `base` and `spans`, arrays of (kind, start, stop) by kind as in KINDS, then start.

    `base` holds the spans of the plain patterns, `spans` these and what the model adds; an added span overlaps no
    other. Positions are code points, stop exclusive. NULL and empty texts have no spans; NULL ids, repeated rows and
    other columns stay as they are, but for columns named base or spans, which are replaced. Rows are worked on where they are, without a shuffle.
    """
    model = model or SpanModel(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    packed, unpacked = packed_rows(docs, "base", "spans")
    rows = packed.withColumns({f"_base_{k}": v for k, v in base_spans(text).items()})
    kind_struct = lambda k: lambda x: F.struct(F.lit(k).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"))
    rows = rows.withColumn("base", F.concat(*(F.transform(f"_base_{k}", kind_struct(i)) for i, k in enumerate(KINDS))))
    has_digit = text.rlike("[0-9]")
    for i, kind in enumerate(KINDS):
        empty = F.array().cast("array<struct<start:int,stop:int,hit:string,before:string,after:string>>")
        proposals = _candidates(text, kind)
        rows = rows.withColumn(f"_wide_{kind}", F.when(has_digit, proposals).otherwise(empty) if kind in WITH_DIGIT else proposals)
        free = lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))
        rows = rows.withColumn(f"_judged_{kind}", F.transform(F.filter(f"_wide_{kind}", free), _featured(i)))
        sure = F.filter(f"_judged_{kind}", model.accepts(kind))
        rows = rows.withColumn(f"_sure_{kind}", F.transform(sure, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"))))
    # Of added spans that overlap each other the first by kind and start stays.
    added = F.array_sort(F.concat(*(F.col(f"_sure_{k}") for k in KINDS)))
    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    apart = F.aggregate(added, none, lambda kept, c: F.when(
        F.exists(kept, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])), kept).otherwise(F.array_append(kept, c)))
    return unpacked(rows.withColumn("spans", F.array_sort(F.concat("base", apart))))


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """`docs` with every span of the text replaced by its kind in brackets; spans that overlap become one.

    NULL texts stay NULL; the other columns, and all rows, stay as they are.
    """
    packed, unpacked = packed_rows(docs)
    found = find_spans(packed, model)
    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    tags = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        return F.when(s["start"] < state["at"], F.struct(F.greatest(state["at"], s["stop"]).alias("at"), state["parts"].alias("parts"))).otherwise(
            F.struct(s["stop"].alias("at"), F.concat(state["parts"], F.array(gap, F.get(tags, s["kind"]))).alias("parts")))

    def finish(state: Column) -> Column:
        rest = F.substring(F.col("text"), state["at"] + 1, F.greatest(F.char_length("text"), F.lit(1)))
        return F.concat(F.array_join(state["parts"], ""), rest)

    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.aggregate(by_place, begin, step, finish))
    return unpacked(found.select("_row", clean.alias("text")))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


@query("op8_pii_spans")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
