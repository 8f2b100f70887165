"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

All of it is DataFrame functions over the row; nothing is shuffled. A pattern is run twice over a text
that can hold it, once for the matches and once for the gaps between them; a match begins after the
lengths of the gaps and matches before it, so positions are running sums and no text is searched
again. Running sums and maxima go by blocks of about the square root of the array, so a very
long text with very many matches costs no square of their number.

Base kinds (``email``, ``ip``, ``card``, ``phone``): leftmost, non-overlapping matches of one pattern each; those that
fail their check are dropped and nothing is tried in their place. They are always reported. Further
spans come from one more pattern and must reach ``ACCEPT``:

* ``iban``: layout and length of the country, confirmed by the remainder 1 modulo 97;
* ``ssn``: three, two and four digits with a valid area, near a word of ``CONTEXT``;
* ``ip``: eight groups of hexadecimal digits;
* ``card``: 13 digits that pass Luhn's check, near a word of ``CONTEXT``;
* ``phone``: 8 to 12 digits in groups, near a word of ``CONTEXT``.

A further span must not touch a letter or digit on either side, and one that overlaps a base span is
dropped unless its checksum confirms it (``iban``). Starts and ends count code points from 0, ends are exclusive.

Edge cases: a NULL or empty text has no spans. Texts of any length are searched whole. Repeated rows
get equal results. An empty table gives an empty result. Extra columns pass through under any name; a column named like the
result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annexport.llm.common import fresh

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")  # spans with one start are listed in this order
BASE = KINDS[:4]

# Patterns of the base kinds. Runs are possessive and begin where a run begins (or where the match before
# ended), which finds the same matches and never scans a run twice.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_CHECK = rf"^{BYTE}(?:\.{BYTE}){{3}}$"

# Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SD": 18,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22,
    "VG": 24, "XK": 20,
}
IBAN = "|".join(
    "(?:{})[0-9]{{2}}(?: ?[A-Z0-9]){{{}}}".format("|".join(k for k, v in IBAN_LENGTHS.items() if v == n), n - 4)
    for n in sorted(set(IBAN_LENGTHS.values()))
)
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
IPV6 = r"[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){7}"
NUMBER = r"[0-9(][0-9]{1,4}\)?(?:[ ./-]?[0-9]{2,4}){2,5}"
FURTHER = f"{IBAN}|{SSN}|{IPV6}|{NUMBER}"

# Words that make a kind likelier, in English, German, French and Spanish.
CONTEXT = {
    "email": "e-mail|email|mail|contact|kontakt|correo|courriel",
    "ip": "ip|host|server|client|address|adresse",
    "card": "card|visa|mastercard|credit|debit|karte|kreditkarte|carte|tarjeta",
    "phone": "phone|telephone|tel|mobile|cell|call|fax|telefon|handy|mobil|téléphone|portable|teléfono|telefono|móvil|movil",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|social security number|tax id",
}
NEAR = 40  # code points before a match in which context words count
ACCEPT = 0.6
CONTEXT_SCORE = 0.4
# Score of the pattern and its checks alone. Base kinds reach ACCEPT by themselves.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.3}
WEAK = {"ip": 0.7, "card": 0.3, "phone": 0.3}  # of the further spans of a base kind

FAR = -(2**31 - 1)  # beyond every negated start


def known(array: Column, value: Column) -> Column:
    """``value``, which looks into ``array`` once for each element of another.

    The size is a second use of it: Spark puts a column's expression where it is used if that is one
    place only, even where it would then be computed for every element.
    """
    return F.when(F.size(array) >= 0, value)


def with_running(rows: DataFrame, wanted: dict[str, tuple[Column, int, Callable[[Column, Column], Column]]]) -> DataFrame:
    """``rows`` with, in each wanted column, for each element of an array what a step makes of all before it, from a start.

    Block totals, totals before each block and the rest within a block are columns of their own, so
    that none is computed again for each element.
    """
    width = lambda xs: F.greatest(F.ceil(F.sqrt(F.size(xs).cast("double"))).cast("int"), F.lit(1))
    block = lambda xs, i: F.call_function("div", i, width(xs)).cast("int")
    fold = lambda xs, start, step: F.aggregate(xs, F.lit(start), lambda a, x: step(a, x))
    temporary = {(k, part): fresh(rows, f"_running_{part}_{k}") for k in wanted for part in ("in", "blocks", "before")}
    c = {k: F.col(v) for k, v in temporary.items()}

    def blocks(k: str, start: int, step: Callable) -> Column:
        xs = c[k, "in"]
        sums = F.transform(
            F.sequence(F.lit(0), block(xs, F.size(xs) - 1)), lambda b: fold(F.slice(xs, b * width(xs) + 1, width(xs)), start, step)
        )
        return F.when(F.size(xs) > 0, sums).otherwise(F.array().cast("array<int>"))

    def before(k: str, start: int, step: Callable) -> Column:
        return F.transform(c[k, "blocks"], lambda x, i: fold(F.slice(c[k, "blocks"], F.lit(1), i), start, step))

    def out(k: str, start: int, step: Callable) -> Column:
        xs = c[k, "in"]
        sums = F.transform(xs, lambda x, i: step(
            F.get(c[k, "before"], block(xs, i)), fold(F.slice(xs, i - i % width(xs) + 1, i % width(xs)), start, step)
        ))
        return known(c[k, "before"], sums)

    rows = rows.withColumns({temporary[k, "in"]: xs for k, (xs, _, _) in wanted.items()})
    rows = rows.withColumns({temporary[k, "blocks"]: blocks(k, *rest) for k, (_, *rest) in wanted.items()})
    rows = rows.withColumns({temporary[k, "before"]: before(k, *rest) for k, (_, *rest) in wanted.items()})
    return rows.withColumns({k: out(k, *rest) for k, (_, *rest) in wanted.items()}).drop(*temporary.values())


def luhn(digits: Column) -> Column:
    """Whether the digits (a text of at most 19) pass Luhn's check."""
    d = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda a, i: a + F.when(i % 2 == 1, d(i)).otherwise(2 * d(i) - F.when(d(i) > 4, 9).otherwise(0)),
    )
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an IBAN without blanks leaves 1 modulo 97, its first four characters put last and letters counted from 10."""
    turned = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, F.lit(1), F.lit(4)))

    def step(a: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, (a * 10 + c - 48) % 97).otherwise((a * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(value)), F.lit(0), step) == 1


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _near(kind: str, gap: Column) -> Column:
    words = rf"(?:^|[^\p{{L}}])(?:{CONTEXT[kind]})(?:[^\p{{L}}]|$)"
    return F.lower(F.right(gap, F.lit(NEAR))).rlike(words)


def _span(kind: str, start: Column, value: Column, gap: Column, alone: float, base: bool) -> Column:
    score = F.lit(alone) + F.when(_near(kind, gap), F.lit(CONTEXT_SCORE)).otherwise(F.lit(0.0))
    return F.struct(
        start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + F.length(value)).alias("end"),
        F.lit(kind).alias("kind"), F.least(score, F.lit(1.0)).alias("score"), value.alias("value"), F.lit(base).alias("base"),
    )


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_CHECK)
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _further(value: Column, start: Column, gap: Column, after: Column) -> Column:
    """The further span that a match of ``FURTHER`` is, or NULL."""
    edge = r"[\p{L}0-9]"
    whole = lambda p: value.rlike(f"^(?:{p})$")
    apart = ~F.right(gap, F.lit(1)).rlike(edge) & ~F.coalesce(F.left(after, F.lit(1)), F.lit("")).rlike(edge)
    area = F.substring(value, 1, 3)
    n = F.length(_digits(value))
    span = lambda kind, alone: _span(kind, start, value, gap, alone, False)
    return F.when(apart, F.when(
        whole(IBAN), F.when(mod97(F.regexp_replace(value, " ", "")), span("iban", SCORES["iban"]))
    ).when(
        whole(SSN), F.when(
            ~area.isin("000", "666") & ~area.startswith("9") & (F.substring(value, 5, 2) != "00") & (F.right(value, F.lit(4)) != "0000"),
            span("ssn", SCORES["ssn"]),
        )
    ).when(whole(IPV6), span("ip", WEAK["ip"])).when(
        (n == 13) & luhn(_digits(value)), span("card", WEAK["card"])
    ).when(n.between(8, 12), span("phone", WEAK["phone"])))


def personal_data(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with the array ``into`` of all spans by start and kind: start, rank (of the kind), end, kind, score, value, base."""
    docs = docs.drop(into) if into != text else docs
    name = {}
    for key in ("text", "digit", *(f"{a}_{k}" for k in (*BASE, "more") for a in ("m", "g", "at", "s")), "base", "all", "left", "right"):
        name[key] = fresh(docs, f"_pii_{key}")
    c = {k: F.col(v) for k, v in name.items()}
    rows = docs.withColumn(name["text"], F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = rows.withColumn(name["digit"], c["text"].rlike("[0-9]"))
    may = {
        "email": c["text"].contains("@"), "ip": c["digit"], "card": c["digit"],
        "phone": c["digit"] & c["text"].contains("+"), "more": c["digit"],
    }
    none = F.array().cast("array<string>")
    found = {}
    for kind in (*BASE, "more"):
        pattern = PATTERNS.get(kind, FURTHER)
        found[kind] = F.when(may[kind], F.regexp_extract_all(c["text"], F.lit(pattern), F.lit(0))).otherwise(none)
    rows = rows.withColumns({name[f"m_{k}"]: v for k, v in found.items()})
    rows = rows.withColumns({
        name[f"g_{k}"]: F.when(F.size(c[f"m_{k}"]) > 0, F.split(c["text"], PATTERNS.get(k, FURTHER), -1)).otherwise(none)
        for k in found
    })

    def lengths(kind: str) -> Column:
        return F.transform(c[f"m_{kind}"], lambda m, i: F.length(m) + F.length(F.get(c[f"g_{kind}"], i)))

    rows = with_running(rows, {name[f"at_{k}"]: (lengths(k), 0, lambda a, b: a + b) for k in found})

    def spans(kind: str) -> Column:
        gap = lambda i: F.get(c[f"g_{kind}"], i)
        start = lambda i: F.get(c[f"at_{kind}"], i) + F.length(gap(i))
        one = (
            (lambda m, i: _further(m, start(i), gap(i), gap(i + 1))) if kind == "more"
            else (lambda m, i: F.when(_passes(kind, m), _span(kind, start(i), m, gap(i), SCORES[kind], True)))
        )
        return F.filter(known(c[f"at_{kind}"], F.transform(c[f"m_{kind}"], one)), lambda s: s.isNotNull())

    rows = rows.withColumns({name[f"s_{k}"]: spans(k) for k in found})
    rows = rows.withColumn(name["base"], F.flatten(F.array(*[c[f"s_{k}"] for k in BASE])))
    scored = F.filter(c["s_more"], lambda s: s["score"] >= ACCEPT)
    rows = rows.withColumn(name["all"], F.sort_array(F.concat(c["base"], scored)))
    # Before a span: the furthest end of a base span; after it: the next start of one.
    some = F.size(c["all"]) > F.size(c["base"])
    ends = F.transform(c["all"], lambda s: F.when(s["base"], s["end"]).otherwise(F.lit(-1)))
    begins = F.transform(F.reverse(c["all"]), lambda s: F.when(s["base"], -s["start"]).otherwise(F.lit(FAR)))
    furthest = lambda a, b: F.greatest(a, b)
    rows = with_running(rows, {
        name["left"]: (F.when(some, ends).otherwise(F.array().cast("array<int>")), -1, furthest),
        name["right"]: (F.when(some, begins).otherwise(F.array().cast("array<int>")), FAR, furthest),
    })
    rows = rows.withColumn(name["right"], F.reverse(c["right"]))
    kept = F.filter(c["all"], lambda s, i: s["base"] | (s["kind"] == "iban") | (
        (F.get(c["left"], i) <= s["start"]) & (-F.get(c["right"], i) >= s["end"])
    ))
    rows = rows.withColumn(into, F.when(some, known(c["left"], known(c["right"], kept))).otherwise(c["all"]))
    return rows.drop(*name.values())


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")
