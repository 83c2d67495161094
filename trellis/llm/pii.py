"""Personal data by weak supervision over candidate spans.

1. Candidates of each text come from the labelers.  Regex labelers: the matches of the base
   patterns (email, ip, card, phone, also those that fail their check) and of looser ones
   (spelled-out addresses, numbers with separators, long runs of mixed letters and digits).
   Gazetteer labelers: given names before a capitalised word, house numbers before a street
   name.  Context labelers: what follows a key such as ``token =`` or a title such as ``Dr``.
   A span's place comes from the pieces between matches: the lengths of pieces and matches are
   summed up.
2. All labelers vote on each candidate: yes (1), no (-1) or abstain (0).  Regex labelers check
   the shape, gazetteers know common mail domains, calling codes, card prefixes, reserved
   networks, key prefixes, given names and street words, context labelers look at the words
   before the span, and one looks at how many different characters a secret has.
3. Expectation-maximisation over all candidates estimates how reliable each labeler is
   (``weak_supervision``) and gives each candidate a probability.
4. These probabilities train the span classifier: weighted naive Bayes over coarse features
   of the span (kind, length, separators, neighbours), which also judges spans no labeler
   knows.  Training reads one aggregate of the table of feature combinations.
5. Final spans: all valid base spans, and the looser candidates that the classifier accepts
   and that overlap neither a base span nor an accepted one that begins before them.

All of it is built-in functions; texts are read once and only candidates and counts move.
Patterns are spelled with possessive quantifiers and look-behind so that they find the same
matches as the plain patterns in linear time and without deep recursion.

Defined results: a null text has no spans; each row is judged for itself, repeated ids too;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import let, register, store, table
from trellis.llm.weak_supervision import fit_label_model

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "name", "address")
ACCEPT = 0.9
CONTEXT = 32
_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

BASE = {
    "email": f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": "(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+ ?(?:\\(at\\)|\\[at\\]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\\(dot\\)|\\[dot\\]|\\.) ?[A-Za-z]{2,24}+){1,4}+",
    "phone": "(?<![0-9A-Za-z+().-])(?:\\([0-9]{2,4}\\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z.-])",
}
KEYS = "token|secret|password|passwd|pwd|passphrase|api[_ -]?key|access[_ -]?key|private[_ -]?key|client[_ -]?secret|bearer"
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Herr|Frau|Señor|Señora|Sr|Sra|Monsieur|Madame|Mme"
GIVEN_NAMES = ("Anna|Anne|Alice|Andrew|Anthony|Barbara|Carlos|Carmen|Charles|Christine|Claire|Daniel|David|Elizabeth|Emily|Emma|Francisco|Hans|Helen|"
               "Isabel|James|Jean|Jennifer|John|José|Joseph|Juan|Julia|Karen|Karl|Klaus|Laura|Linda|Lisa|Louis|Lucas|Luis|Manuel|Marie|María|Mark|"
               "Martin|Mary|Michael|Michel|Nancy|Paul|Peter|Pierre|Richard|Robert|Sarah|Sofia|Sophie|Stefan|Susan|Thomas|William|Wolfgang")
STREETS = "Street|Avenue|Road|Lane|Boulevard|Drive|Court|Square|Terrace|St|Ave|Rd|Blvd"
_CAPITAL = "[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20}+"
_RUN = "[A-Za-z0-9_+/=-]"
LOOSE |= {
    "secret": f"(?i)\\b(?:{KEYS})[\"']?\\s{{0,3}}[:=]\\s{{0,3}}[\"']?[^\\s\"':=]{{6,256}}+"
              f"|(?<!{_RUN})(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z]){_RUN}{{16,256}}+",
    "name": f"\\b(?:(?:{TITLES})\\b\\.? {_CAPITAL}(?: {_CAPITAL})?+|(?:{GIVEN_NAMES}) {_CAPITAL})",
    "address": f"(?<![0-9A-Za-z.,-])[1-9][0-9]{{0,4}}+ {_CAPITAL}(?: {_CAPITAL})?? (?:{STREETS})\\b",
}
# The key before a secret and the title before a name are found with the span and are not part of it.
LEAD = {"secret": f"^(?i)(?:{KEYS})[\"']?\\s{{0,3}}[:=]\\s{{0,3}}[\"']?", "name": f"^(?:{TITLES})\\b\\.? "}
# Something that must be in the text for the pattern to match; a cheap test first.
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
LOOSE_HINT = {"email": "at", "phone": None, "secret": None, "name": " ", "address": " "}

# Gazetteers, short and public.
MAIL_DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|us|it|nl|ch|at|be|pl|se|jp|cn|in|br|ru"
CALLING_CODES = "1|7|20|27|30|31|32|33|34|36|39|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
CARD_PREFIXES = "4|5[1-5]|2[2-7]|3[47]|6011|65|35"
RESERVED_NETS = "0|127|255|22[4-9]|23[0-9]"
SECRET_PREFIXES = "AKIA|ASIA|gh[pousr]_|github_pat_|sk[-_]|pk[-_]|xox[abpr]-|eyJ|glpat-|AIza"
YES_WORDS = "mail|email|e-mail|contact|write to|call|phone|tel|mobile|fax|card|visa|account|ip|address|host|login|name"
NO_WORDS = "version|release|isbn|issn|order|invoice|part|serial|figure|table|section|page|chapter|total|price|ratio|build"


def prefix_sums(values: Column) -> Column:
    """For each element the sum of those before it, in two levels of about sqrt(n) elements."""
    def of(v: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(v))).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / step).cast("int")),
                             lambda c: F.slice(v, c * step + 1, step))
        run = lambda a: F.aggregate(a, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

        def join(within: Column) -> Column:
            starts = run(F.transform(within, lambda w: F.element_at(w, -1)))
            return let(starts, lambda s: F.flatten(F.transform(
                within, lambda w, c: F.transform(F.slice(w, 1, F.size(w) - 1), lambda x: x + F.get(s, c)))))

        return let(F.transform(chunks, run), join)

    return let(values, of)


_SPAN = "array<struct<kind:int,begin:int,end:int,body:string,before:string,loose:boolean>>"


def find_spans(text: Column, pattern: str, kind: int, loose: bool, hint: str | None) -> Column:
    """Leftmost non-overlapping matches with their places in code points (end exclusive)."""
    none = F.array().cast(_SPAN)

    def place(found: Column) -> Column:
        def of(pieces: Column) -> Column:
            sizes = F.transform(found, lambda m, i: F.length(F.get(pieces, i)) + F.length(m))
            return let(prefix_sums(sizes), lambda at: F.transform(found, lambda m, i: F.struct(
                F.lit(kind).alias("kind"),
                (F.get(at, i) + F.length(F.get(pieces, i))).alias("begin"),
                (F.get(at, i) + F.length(F.get(pieces, i)) + F.length(m)).alias("end"),
                m.alias("body"),
                F.lower(F.right(F.get(pieces, i), F.lit(CONTEXT))).alias("before"),
                F.lit(loose).alias("loose"))).cast(_SPAN))

        return let(F.split(text, pattern, -1), of)

    def without_lead(spans: Column, lead: str) -> Column:
        def cut(s: Column) -> Column:
            return let(F.regexp_extract(s["body"], lead, 0), lambda k: F.struct(
                s["kind"].alias("kind"), (s["begin"] + F.length(k)).alias("begin"), s["end"].alias("end"),
                F.substr(s["body"], F.length(k) + 1).alias("body"),
                F.when(k == "", s["before"]).otherwise(F.concat(s["before"], F.lower(k))).alias("before"), s["loose"].alias("loose")).cast(_SPAN[6:-1]))
        return F.transform(spans, cut)

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda found: F.when(F.size(found) == 0, none).otherwise(place(found)))
    if KINDS[kind] in LEAD:
        spans = without_lead(spans, LEAD[KINDS[kind]])
    return spans if hint is None else F.when(F.contains(text, F.lit(hint)), spans).otherwise(none)


def candidates(text: Column) -> Column:
    """All candidate spans of a text."""
    every = [find_spans(text, BASE[k], n, False, HINT[k]) for n, k in enumerate(BASE_KINDS)]
    every += [find_spans(text, p, KINDS.index(k), True, LOOSE_HINT[k]) for k, p in LOOSE.items()]
    return F.concat(*every)


def valid(span: Column) -> Column:
    """The check of a base match of its kind."""
    body, kind = span["body"], span["kind"]
    digits = F.regexp_replace(body, "[^0-9]", "")
    return (~span["loose"]) & (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, body.rlike(f"^{_OCTET}(?:\\.{_OCTET}){{3}}$"))
        .when(kind == 2, F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(False))
        .otherwise(F.length(digits).between(10, 15)))


def span_facts(span: Column) -> Column:
    """What later steps need of a candidate: place, base or not, votes and features."""
    body, kind, before = span["body"], span["kind"], span["before"]
    digits = F.length(F.regexp_replace(body, "[^0-9]", ""))
    size = F.length(body)
    yes_no = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    secret, name, address = kind == 4, kind == 5, kind == 6
    mixed = body.rlike("^[0-9A-Fa-f]{24,}$") | (body.rlike("^[A-Za-z0-9_+/=-]{20,}$") & (digits * 8 >= size) & (digits < size))
    loose_shape = (F.when(kind == 0, yes_no(body.rlike("(?i)[a-z]{2,}$"), F.lit(False)))
                   .when(secret, yes_no(mixed, body.rlike("^(?:[A-Za-z]+|[0-9]+)(?:[-/_=+](?:[A-Za-z]+|[0-9]+))+$") | body.rlike("^[A-Za-z]*$")))
                   .when(name, yes_no(body.rlike(f"^{_CAPITAL} {_CAPITAL}$"), F.lit(False)))
                   .when(address, yes_no(F.lit(True), F.lit(False)))
                   .otherwise(yes_no(digits.between(9, 12), F.lit(False))))
    shape = F.when(span["loose"], loose_shape).otherwise(yes_no(valid(span), ~valid(span)))
    gazetteer = (
        F.when(kind == 0, yes_no(body.rlike(f"(?i)[. ](?:{MAIL_DOMAINS})$"), body.rlike("[0-9]$")))
        .when(kind == 1, yes_no(F.lit(False), body.rlike(f"^(?:{RESERVED_NETS})\\.")))
        .when(kind == 2, yes_no(body.rlike(f"^(?:{CARD_PREFIXES})"), body.rlike("^0")))
        .when(secret, yes_no(body.rlike(f"^(?:{SECRET_PREFIXES})"), F.lit(False)))
        .when(name, yes_no(body.rlike(f"^(?:{GIVEN_NAMES})\\b"), body.rlike(f"\\b(?:{STREETS})$")))
        .when(address, yes_no(body.rlike(f"\\b(?:{STREETS})$"), F.lit(False)))
        .otherwise(yes_no(body.rlike(f"^\\+(?:{CALLING_CODES})"), body.rlike("^\\+?0"))))
    context = (F.when(secret, yes_no(before.rlike(f"(?:{KEYS})[\"']?\\s*[:=]\\s*[\"']?$"), before.rlike("(?:https?://|www\\.)\\S*$")))
               .when(name, yes_no(before.rlike(f"(?i)(?:\\b(?:{TITLES})\\.? |name *[:=] *|contact *[:=] *|dear )$"), F.lit(False)))
               .when(address, yes_no(before.rlike("\\b(?:at|address|live[sd]?|home|to|office)\\b[^.!?\\n]*$"), F.lit(False)))
               .otherwise(yes_no(before.rlike(f"\\b(?:{YES_WORDS})\\b[^.!?\\n]*$"), before.rlike(f"\\b(?:{NO_WORDS})\\b[^.!?\\n]*$"))))
    variety = F.size(F.array_distinct(F.split(body, "")))
    length = (F.when(kind == 0, yes_no(size.between(6, 64), size < 6))
              .when(kind == 1, yes_no(size.between(7, 15), size > 15))
              .when(kind == 2, yes_no(digits.between(14, 19), (digits < 14) | (digits > 19)))
              .when(secret, yes_no((size >= 16) & (variety >= 9), variety < 5))
              .when(name | address, yes_no(size.between(6, 60), F.lit(False)))
              .otherwise(yes_no(digits.between(9, 15), (digits < 9) | (digits > 15))))
    glued = yes_no(F.lit(False), ~secret & before.rlike("[0-9a-z_/=-]$"))
    return F.struct(
        kind.alias("kind"), span["begin"].alias("begin"), span["end"].alias("end"), valid(span).alias("base"),
        span["loose"].alias("loose"),
        shape.alias("v_shape"), gazetteer.alias("v_gazetteer"), context.alias("v_context"),
        length.alias("v_length"), glued.alias("v_glued"),
        (kind * 2 + span["loose"].cast("int")).alias("f_kind"),
        F.least(F.floor(size / 6).cast("int"), F.lit(6)).alias("f_size"),
        F.least(F.floor(digits * 5 / size).cast("int"), F.lit(5)).alias("f_digits"),
        F.when(body.rlike("[()]"), 2).when(body.rlike("[ -]"), 1).otherwise(0).alias("f_marks"),
        F.when(before.rlike("[:=]\\s*$"), 2).when(before.rlike("(?:^|\\s)$"), 1).otherwise(0).alias("f_before"))


VOTERS = ("v_shape", "v_gazetteer", "v_context", "v_length", "v_glued")
FEATURES = {"f_kind": 14, "f_size": 7, "f_digits": 6, "f_marks": 3, "f_before": 3}


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the candidate spans of each text with votes and features."""
    return docs.select("doc_id", F.transform(candidates(F.coalesce(F.col("text"), F.lit(""))), span_facts).alias("spans"))


def train_classifier(spans: DataFrame) -> tuple[float, Mapping[str, list[float]]]:
    """(bias, weight of each value of each feature) of the span classifier.

    ``spans`` is the found candidates; the label model's probabilities are the labels."""
    flat = spans.select(F.inline("spans"))
    cells = store(flat.groupBy(*VOTERS, *FEATURES).agg(F.count("*").alias("n")), "pii-cells")
    model = fit_label_model(cells, VOTERS, share=0.5)
    rated = cells.withColumn("yes", F.col("n") * model.probability()).withColumn("no", F.col("n") - F.col("yes"))
    sums = [F.sum(c).alias(c) for c in ("yes", "no")]
    sums += [F.sum(F.when(F.col(f) == v, F.col(c)).otherwise(0)).alias(f"{f}_{v}_{c}")
             for f, k in FEATURES.items() for v in range(k) for c in ("yes", "no")]
    got = rated.agg(*sums).first()  # one row of sums
    yes, no = got["yes"] or 0.0, got["no"] or 0.0
    bias = round(math.log((yes + 1) / (no + 1)), 6)
    weights = {f: [round(math.log((got[f"{f}_{v}_yes"] or 0) + 1) - math.log(yes + k)
                         - math.log((got[f"{f}_{v}_no"] or 0) + 1) + math.log(no + k), 6) for v in range(k)]
               for f, k in FEATURES.items()}
    return bias, weights


def classify(span: Column, bias: float, weights: Mapping[str, list[float]]) -> Column:
    """Probability that a candidate is personal data."""
    odds = F.lit(bias)
    for f, w in weights.items():
        odds = odds + F.get(F.lit(w), span[f])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def tag_spans(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, base (valid base spans) and spans (base and accepted ones), each an array of
    (begin, kind, end) in order of begin, then kind."""
    found = store(find_candidates(docs), "pii-candidates")
    bias, weights = train_classifier(found)
    place = lambda s: F.struct(s["begin"].alias("begin"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.transform(F.filter("spans", lambda s: s["base"]), place)
    more = F.transform(F.filter("spans", lambda s: s["loose"] & (classify(s, bias, weights) >= accept)), place)
    meet = lambda x, y: (x["begin"] < y["end"]) & (y["begin"] < x["end"])
    earlier = lambda x, y: (x["begin"] < y["begin"]) | ((x["begin"] == y["begin"]) & (x["kind"] < y["kind"]))
    free = let(base, lambda b: F.filter(more, lambda s: ~F.exists(b, lambda x: meet(x, s))))
    apart = let(free, lambda m: F.filter(m, lambda s: ~F.exists(m, lambda x: meet(x, s) & earlier(x, s))))
    return (found.select("doc_id", F.array_sort(base).alias("base"), apart.alias("more"))
            .select("doc_id", "base", F.array_sort(F.concat("base", "more")).alias("spans")))


def spans_text(spans: Column) -> Column:
    """kind:begin:end, joined by commas."""
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["begin"], s["end"])), ",")


@register("op3_pii_label_model")
def op3_pii_label_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts, digest of the base spans, all spans."""
    tagged = tag_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return tagged.select(
        "doc_id", *(count(n).alias(f"n_{k}") for n, k in enumerate(BASE_KINDS)),
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
        F.size("spans").cast("long").alias("n_spans"), (F.size("spans") > 0).alias("has_personal_data"))
