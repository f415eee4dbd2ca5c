"""Personal data by candidate gradient boosting.

Base patterns give e-mail addresses, IP addresses, card numbers and phone numbers, with their validity rules; these spans always
stay. High-recall generators propose further spans, which may overlap: spelled-out addresses, numbers without their usual
form. Boosted trees on format and context features give each a chance; a threshold for each kind, calibrated on labelled
candidates that the trees did not see, selects what is added. Of overlapping spans a base one stays, else the likeliest.

The trees learn from two tables. One is of the documents themselves: matches of the base patterns, valid ones (label 1) and those
that fail their rules (label 0), rewritten as the generators' forms and left in their own contexts; about ``REAL`` at most of
each kind and label, drawn by hash. The other (``seed_candidates``) is made by rule, for forms and contexts that the documents
lack: there the label follows from the span's form for most, and from the words beside it for the rest.

Everything is DataFrame functions and Spark's own ML. A pattern's places come from the lengths of what lies between its
matches. Patterns are possessive and start at the start of a run only, so they take linear time on any text.

Offsets are in code points, the end exclusive. Null texts count as empty. Rows of one id and equal text are one row; rows of
one id and different texts are a row each. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillgrid.llm.common import cut, held

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, equal in what they match to those of the contract.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?=[0-9][ -]?[0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators: what else may be such a span.
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[{] ?at ?[)\]}] ?| at )[A-Za-z0-9-]{1,63}+(?:(?: ?[(\[{] ?dot ?[)\]}] ?| dot |\.)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/ -]?[0-9]{4}){2}[._/ -]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9])",
}
#: Texts without a sign of a pattern need not be searched.
SIGN = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
MORE_SIGN = {"email": r"[(\[{] ?at ?[)\]}]| at [A-Za-z0-9-]+(?: dot |\.)[A-Za-z0-9]", "ip": r"[0-9] ?(?:\.|\[\.\]|\(\.\)) ?[0-9]", "card": r"[0-9]{4}[._/ -]?[0-9]{4}", "phone": r"[0-9]{3,4}[ .-][0-9]{4}"}
CONTEXT = 24  # characters that are looked at on either side
FOR_WORDS = r"\b(?:call|phone|tel|mobile|fax|contact|reach|mail|email|e-mail|write|card|visa|pay|payment|ip|host|server|address)\b"
AGAINST_WORDS = r"\b(?:order|version|serial|isbn|id|ref|page|code|section|item|total|invoice|build|release|chapter|part|figure)\b"
ENDS = r"(?i)(?:\.|dot[)\]}]? ?)(?:com|org|net|edu|gov|info|io|eu|us|uk|de|fr|es|it|nl)$"  # what addresses end in
SEEDS, REAL, TREES, DEPTH, PRECISION = 4000, 500, 20, 5, 0.95


def _found(text: Column, kind: str, pattern: str, sign: str, base: bool) -> Column:
    """What lies between a pattern's matches, and the matches."""
    there = text.contains(sign) if len(sign) == 1 else text.rlike(sign)
    parts = F.when(there, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))
    matches = F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), parts.alias("parts"), matches.alias("matches"))


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits, 19 at most, passes Luhn's test."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        d = F.coalesce(F.ascii(F.substring(digits, i, F.lit(1))) - 48, F.lit(0))
        return total + F.when((F.length(digits) - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.when(F.length(digits) <= 19, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(F.lit(False))


def _octets(span: Column) -> Column:
    return F.forall(F.split(span, r"\."), lambda p: p.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"))


def _valid(kind: Column, span: Column) -> Column:
    """The validity rules of base matches."""
    digits = _digits(span)
    n = F.length(digits)
    return F.when(kind == "email", F.lit(True)).when(kind == "ip", _octets(span)).when(kind == "card", n.between(14, 19) & _luhn(digits)).otherwise(n.between(10, 15))


def candidates(texts: DataFrame) -> DataFrame:
    """(doc_id, t, kind, base, start, end, span, before, after): a row for each match, and one with kind null for each text."""
    every = F.struct(F.lit(None).cast("string").alias("kind"), F.lit(True).alias("base"), F.array(F.lit("")).alias("parts"), F.array(F.lit("")).alias("matches"))
    text = F.col("text")
    searched = [_found(text, k, BASE[k], SIGN[k], True) for k in KINDS] + [_found(text, k, MORE[k], MORE_SIGN[k], False) for k in KINDS]
    found = texts.select("doc_id", "t", F.explode(F.array(every, *searched)).alias("f")).where(F.size("f.matches") > 0)
    found = found.select("doc_id", "t", "f.kind", "f.base", F.posexplode(F.arrays_zip(F.col("f.parts").alias("part"), F.slice("f.parts", 2, 2147483647).alias("next"), F.col("f.matches").alias("span"))).alias("k", "z"))
    found = found.select("doc_id", "t", "kind", "base", "k", F.length("z.part").alias("gap"), F.col("z.span").alias("span"), F.substring("z.part", -CONTEXT, CONTEXT).alias("before"), F.substring("z.next", 1, CONTEXT).alias("after")).where("span is not null")
    found = found.dropDuplicates(["doc_id", "t", "kind", "base", "k"])
    so_far = Window.partitionBy("doc_id", "t", "kind", "base").orderBy("k")
    start = F.sum(F.col("gap") + F.length("span")).over(so_far) - F.length("span")
    return found.withColumn("start", start).withColumn("end", F.col("start") + F.length("span")).drop("k", "gap")


FEATURES = ("is_email", "is_ip", "is_card", "is_phone", "n_digits", "n_chars", "n_signs", "n_kinds_of_signs", "n_digits_met", "luhn", "octets", "bracket", "for_words", "against_words", "letter_before", "letter_after", "digit_near", "known_end", "first_digit", "n_parts", "n_words_at")


def with_features(spans: DataFrame) -> DataFrame:
    span, digits = F.col("span"), _digits(F.col("span"))
    signs = F.regexp_replace(span, "[A-Za-z0-9]", "")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    count = lambda s: F.length(s).cast("double")
    near = F.lower(F.concat_ws(" ", "before", "after"))
    return spans.withColumns(
        {f"is_{k}": flag(F.col("kind") == k) for k in KINDS}
        | {
            "n_digits": count(digits), "n_chars": count(span), "n_signs": count(signs), "n_kinds_of_signs": F.size(F.array_distinct(F.split(signs, ""))).cast("double"),
            "n_digits_met": F.size(F.array_distinct(F.split(digits, ""))).cast("double"), "luhn": flag(F.length(digits).between(12, 19) & _luhn(digits)), "octets": flag(_octets(F.regexp_replace(span, r"[^0-9.]", ""))),
            "bracket": flag(span.startswith("(")), "for_words": flag(near.rlike(FOR_WORDS)), "against_words": flag(near.rlike(AGAINST_WORDS)), "letter_before": flag(F.col("before").rlike("[A-Za-z_]$")),
            "letter_after": flag(F.col("after").rlike("^[A-Za-z_]")), "known_end": flag(span.rlike(ENDS)), "first_digit": F.coalesce(F.substring(digits, 1, 1).try_cast("double"), F.lit(-1.0)),
            "n_parts": F.size(F.split(span, "[^A-Za-z0-9]+")).cast("double"), "n_words_at": flag(span.rlike(r"^[a-z]+ at [a-z]+")), "digit_near": flag(F.col("before").rlike("[0-9][ .-]?$") | F.col("after").rlike("^[ .-]?[0-9]")),
        }
    )


def _draws():
    """Draws by the hash of a row's id: a number below n, one of some texts, a number of some digits."""
    h = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    pick = lambda k, *of: F.element_at(F.array(*map(F.lit, of)), (h(k, len(of)) + 1).cast("int"))
    number = lambda k, width: F.lpad(h(k, 10**width).cast("string"), width, "1")
    return h, pick, number


def _joined(parts: Column, by: Column) -> Column:
    return F.call_function("array_join", parts, by)


def disguised(kind: Column, span: Column) -> Column:
    """A base match in one of the generators' forms."""
    _, pick, _ = _draws()
    digits = _digits(span)
    at, dot = pick("at", " (at) ", "[at]", " [at] ", " at "), pick("dot", " (dot) ", "[dot]", ".", " dot ")
    email = F.concat(F.substring_index(span, "@", 1), at, _joined(F.split(F.substring_index(span, "@", -1), r"\."), dot))
    ip = _joined(F.split(span, r"\."), pick("ip", "[.]", "(.)", " . ", "."))
    card = _joined(F.regexp_extract_all(digits, F.lit("[0-9]{1,4}"), F.lit(0)), pick("card", ".", "/", "_", "-"))
    ten = F.lpad(F.substring(digits, -10, 10), 10, "2")
    phone = F.concat(pick("open", "(", ""), F.substring(ten, 1, 3), F.when(pick("open", "(", "") == "(", ") ").otherwise("-"), F.substring(ten, 4, 3), pick("mid", "-", ".", " "), F.substring(ten, 7, 4))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).otherwise(phone)


def real_candidates(spans: DataFrame, most: int = REAL) -> DataFrame:
    """Labelled candidates of the documents: about ``most`` base matches of each kind, valid and not, drawn by hash, in other forms."""
    base = spans.where("base and kind is not null").select(F.xxhash64("doc_id", "t", "kind", "start").alias("id"), "kind", "span", "before", "after", F.col("ok").cast("double").alias("label"))
    counts = base.groupBy("kind", "label").agg(F.count("*").alias("n"))  # eight rows at most
    drawn = base.join(F.broadcast(counts), ["kind", "label"]).where(F.pmod(F.xxhash64("id", F.lit("drawn")), F.col("n")) < most).drop("n")
    return drawn.select("id", "kind", disguised(F.col("kind"), F.col("span")).alias("span"), "before", "after", "label")


def seed_candidates(spark: SparkSession, n: int = SEEDS) -> DataFrame:
    """Labelled candidates (id, kind, span, before, after, label), made by rule. A form that cannot be (a failing check digit, an
    octet over 255, an address without a known ending, an area code from 0 or 1) is none anywhere; of forms that can be, those
    after words that announce other things are none, but for cards. Words beside are announcing ones, others, or of no list."""
    h, pick, number = _draws()
    joined = lambda by, *parts: F.concat(parts[0], *[x for p in parts[1:] for x in (by, p)])
    kind = pick("kind", *KINDS)
    person = pick("a", "ann", "bob", "eva", "kim", "lee", "info", "sales", "m.ruiz", "j_doe", "we", "they", "look", "meet")
    email = F.concat(person, F.when(h("digits", 3) == 0, number("b", 2)).otherwise(""), pick("c", " (at) ", "[at]", " at ", " [at] "), pick("d", "mail", "post", "corp", "home", "work", "noon"), pick("e", " (dot) ", " dot ", ".", "[dot]"), pick("f", "com", "org", "net", "de", "then", "and", "it is", "x"))
    ip = joined(pick("g", " . ", "[.]", "(.)"), *[h(f"o{i}", 256).cast("string") if i else F.when(h("big", 3) == 0, 256 + h("more", 700)).otherwise(h("o0", 256)).cast("string") for i in range(4)])
    fifteen = F.concat(*[number(f"q{i}", 5) for i in range(3)])
    check = F.array_min(F.filter(F.array(*map(F.lit, range(10))), lambda k: _luhn(F.concat(fifteen, k.cast("string")))))
    sixteen = F.concat(fifteen, F.when(h("valid", 2) == 0, check).otherwise((check + 1 + h("off", 9)) % 10).cast("string"))
    card = _joined(F.regexp_extract_all(sixteen, F.lit("[0-9]{4}"), F.lit(0)), pick("i", ".", "-", "/", "_"))
    area = F.concat(h("k0", 10).cast("string"), number("k", 2))
    phone = F.concat(pick("j", "(", ""), area, F.when(pick("j", "(", "") == "(", ") ").otherwise("-"), number("l", 3), pick("m", "-", ".", " "), number("n", 4))
    place = h("place", 10)
    told = F.when(place <= 2, pick("p", "call ", "phone ", "contact ", "mail ", "card ", "ip ", "host ", "reach ", "write to ")).when(place <= 4, pick("r", "order ", "version ", "serial ", "ref ", "page ", "id ", "build ", "total ")).otherwise(pick("s", "the ", "and ", "of ", "", "see ", "my ", "from ", "with "))
    rows = spark.range(0, n, 1, 2).select("id", kind.alias("kind"), F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).otherwise(phone).alias("span"), told.alias("before"), pick("t", " and", ".", " the", ", or", "").alias("after"), (place.between(3, 4)).alias("other"))
    span, digits = F.col("span"), _digits(F.col("span"))
    can_be = F.when(F.col("kind") == "email", span.rlike(ENDS)).when(F.col("kind") == "ip", _octets(F.regexp_replace(span, "[^0-9.]", ""))).when(F.col("kind") == "card", _luhn(digits)).otherwise(F.substring(digits, 1, 1) >= "2")
    return rows.select("id", "kind", "span", "before", "after", (can_be & (~F.col("other") | (F.col("kind") == "card"))).cast("double").alias("label"))


def fit(labelled: DataFrame) -> tuple[PipelineModel, dict[str, float]]:
    """The trees, fitted on three quarters of the labelled candidates, and each kind's threshold: the lowest chance from which
    PRECISION of the other quarter's candidates of the kind are right; 1.01 (nothing) where there is none."""
    rows = cut(with_features(labelled).withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(4))))
    steps = [VectorAssembler(inputCols=list(FEATURES), outputCol="features"), GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7)]
    model = Pipeline(stages=steps).fit(rows.where("fold > 0"))
    tried = model.transform(rows.where("fold = 0")).select("kind", "label", vector_to_array("probability")[1].alias("p"))
    down = Window.partitionBy("kind").orderBy(F.desc("p")).rangeBetween(Window.unboundedPreceding, 0)
    good = tried.withColumn("precision", F.avg("label").over(down)).where(F.col("precision") >= PRECISION).groupBy("kind").agg(F.min("p").alias("p")).collect()
    return model, {k: 1.01 for k in KINDS} | {r.kind: r.p for r in good}


def find_pii(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone (base spans), base_spans and spans (kind:start:end, comma-joined, by start, then kind)."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    spans = cut(candidates(held(texts, "t", F.xxhash64("text"))).withColumn("ok", F.when(F.col("base"), F.col("kind").isNull() | _valid(F.col("kind"), F.col("span"))).otherwise(F.lit(False))))
    model, least = fit(labelled if labelled is not None else seed_candidates(docs.sparkSession).unionByName(real_candidates(spans)))
    fixed = spans.where("ok")
    # what the generators propose, unless a base span lies there
    proposed = spans.where("not base").select("doc_id", "t", "kind", "start", "end", "span", "before", "after")
    taken = fixed.where("kind is not null").select("doc_id", "t", F.col("start").alias("s"), F.col("end").alias("e"))
    free = proposed.join(taken, (proposed.doc_id.eqNullSafe(taken.doc_id)) & (proposed.t == taken.t) & (proposed.start < taken.e) & (taken.s < proposed.end), "left_anti")
    chosen = model.transform(with_features(free)).withColumn("p", vector_to_array("probability")[1])
    chosen = chosen.where(reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("p") >= least[k]) for k in KINDS])).select("doc_id", "t", "kind", "start", "end", "p")
    chosen = cut(chosen)
    other = chosen.select("doc_id", "t", F.col("kind").alias("k2"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("p").alias("p2"))
    better = (other.p2 > chosen.p) | ((other.p2 == chosen.p) & (F.struct(other.s, other.e, other.k2) < F.struct(chosen.start, chosen.end, chosen.kind)))
    added = chosen.join(other, (chosen.doc_id.eqNullSafe(other.doc_id)) & (chosen.t == other.t) & (chosen.start < other.e) & (other.s < chosen.end) & better, "left_anti")
    every = fixed.select("doc_id", "t", "kind", "start", "end", F.lit(True).alias("base")).union(added.select("doc_id", "t", "kind", "start", "end", F.lit(False)))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.when(F.col("kind").isNotNull(), F.struct("start", order.alias("order"), "end", "kind", "base"))
    lists = every.groupBy("doc_id", "t").agg(F.sort_array(F.collect_list(item)).alias("all"), *[F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS])
    joined = lambda of: F.array_join(F.transform(of, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return lists.select(F.col("doc_id").alias(id_col), *[f"n_{k}" for k in KINDS], joined(F.filter("all", lambda x: x["base"])).alias("base_spans"), joined(F.col("all")).alias("spans"))
