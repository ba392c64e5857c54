"""Format-preserving pseudonyms for personal data, in column expressions alone.

Card numbers (Luhn), social security numbers, phone numbers, IPv4 addresses and dates
are checked and then permuted within their own format by a keyed Feistel network over
two residues: a card stays a valid card of as many digits, a date a valid date, and
separators stay where they are.  A permutation never maps two values to one, and equal
values get equal pseudonyms in every document.  Mail addresses, which are no numbers,
become keyed hashes in the form of an address.

A residue pair (l, r) of sizes A and B goes through rounds
``l = (l + F(i, r)) mod A`` and ``r = (r + F(i, l)) mod B`` in turn, F being a keyed
SHA-256; each round can be undone, so no cycle walking is needed for odd sizes.

Defined results: NULL stays NULL; a text without a valid value is returned unchanged, as
is every number that fails its check (``4111 1111 1111 1112``, octets above 255, 30
February); dates count from 1800-01-01 to 2199-12-31; all other columns, also clashing
ones, and repeated rows stay as they are.  A text is read once, whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.text import documents

KINDS = ("mail", "card", "ssn", "phone", "ip", "date")

_CARD = r"(?:\d{13,19}|(?:\d{4} ){3}\d{1,7}|(?:\d{4}-){3}\d{1,7}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})"
_SSN = r"\d{3}-\d{2}-\d{4}"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4})"
#: After a plus sign 8 to 15 digits as they are usually grouped, up to a number of another kind.
_OTHER = rf" (?:{_CARD}|{_SSN}|{_DATE}|{_IP})(?![A-Za-z0-9]|[.-]\d)"
_PHONE = rf"(?:\+?1[ .-]?)?(?:\(\d{{3}}\)[ .-]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}|\+\d(?:(?!{_OTHER})[ ./-]?[(]?\d[)]?){{7,14}}"
_LABEL, _OTHER_LABELS = r"[A-Za-z0-9-]++", r"(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+"
#: Up to the last label that starts with two letters.  All loops are possessive, which the engine runs without recursion.
_DOMAIN = rf"{_LABEL}(?:{_OTHER_LABELS}\.(?=[A-Za-z]{{2}}){_LABEL}(?={_OTHER_LABELS}\.[A-Za-z]{{2}}))*+{_OTHER_LABELS}\.[A-Za-z]{{2,}}"
#: Longer forms first; a number is never taken out of a longer run of letters or digits.
PATTERN = (
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@{_DOMAIN}"
    rf"|(?<![A-Za-z0-9+]|\d[.-])(?:{_CARD}|{_SSN}|{_DATE}|{_IP}|{_PHONE})(?![A-Za-z0-9]|[.-]\d)"
)


@dataclass(frozen=True)
class Settings:
    """key: whoever knows it can undo the pseudonyms, so pass a secret.  rounds: an even number, 8 or more."""

    key: str = field(repr=False)
    rounds: int = 10


Body = Callable[[F.Column], F.Column]


def _let(value: F.Column, body: Body) -> F.Column:
    """``body`` of the value, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _digits(of: F.Column) -> F.Column:
    return F.regexp_replace(of, "[^0-9]", "")


def _part(of: F.Column, start: F.Column | int, length: F.Column | int) -> F.Column:
    start, length = (x if isinstance(x, F.Column) else F.lit(x) for x in (start, length))
    return F.substr(of, start, length)


class Feistel:
    """Keyed permutations of pairs of residues, and what the formats make of them."""

    def __init__(self, secret: F.Column, rounds: int) -> None:
        self.secret, self.rounds = secret, rounds

    def moved(self, kind: str, left: F.Column, right: F.Column, size_left: F.Column, size_right: F.Column) -> F.Column:
        """A struct (l, r) of the permuted residues."""

        def mask(i: F.Column, of: F.Column, size: F.Column) -> F.Column:
            message = F.concat(self.secret, F.lit(f"|{kind}|"), i.cast("string"), F.lit("|"), size_left.cast("string"), F.lit("|"), of.cast("string"))
            return F.conv(F.substr(F.sha2(message, 256), F.lit(1), F.lit(15)), 16, 10).cast("long") % size

        def turn(s: F.Column, i: F.Column) -> F.Column:
            first = F.struct(((s["l"] + mask(i, s["r"], size_left)) % size_left).alias("l"), s["r"].alias("r"))
            second = F.struct(s["l"].alias("l"), ((s["r"] + mask(i, s["l"], size_right)) % size_right).alias("r"))
            return F.when(i % 2 == 1, first).otherwise(second)

        start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
        return F.reduce(F.sequence(F.lit(1), F.lit(self.rounds)), start, turn)

    def digits(self, kind: str, prefix: F.Column, body: F.Column) -> F.Column:
        """The digits of ``body`` permuted among all texts of as many digits, after ``prefix``."""

        def halves(u: F.Column, v: F.Column) -> F.Column:
            size = lambda n: F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")
            moved = self.moved(kind, _part(body, 1, u), F.substr(body, u + 1), size(u), size(v))
            pad = lambda x, n: F.lpad(x.cast("string"), n, F.lit("0"))
            return _let(moved, lambda f: F.concat(prefix, pad(f["l"], u), pad(f["r"], v)))

        half = F.floor(F.length(body) / 2).cast("int")
        return halves(half, F.length(body) - half)

    def card(self, m: F.Column, d: F.Column) -> F.Column:
        moved = self.digits("card", F.lit(""), _part(d, 1, F.length(d) - 1))
        return _let(moved, lambda b: _refill(m, F.concat(b, ((10 - _luhn(b, 0) % 10) % 10).cast("string"))))

    def ssn(self, d: F.Column) -> F.Column:
        area, group, serial = _ssn_parts(d)
        left, right = area - 1 - (area > 666).cast("int"), (group - 1) * 9999 + serial - 1
        moved = self.moved("ssn", left, right, F.lit(898), F.lit(989901))
        area_of = lambda f: f["l"] + 1 + (f["l"] >= 665).cast("int")
        return _let(moved, lambda f: F.format_string("%03d-%02d-%04d", area_of(f), F.floor(f["r"] / 9999) + 1, f["r"] % 9999 + 1))

    def phone(self, m: F.Column, d: F.Column) -> F.Column:
        """The last ten digits are permuted, a country's code stays."""
        kept = F.greatest(F.lit(0), F.length(d) - 10)
        return _let(self.digits("phone", _part(d, 1, kept), F.substr(d, kept + 1)), lambda n: _refill(m, n))

    def ip(self, m: F.Column) -> F.Column:
        octet = [F.split_part(m, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
        moved = self.moved("ip", octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], F.lit(65536), F.lit(65536))
        whole = lambda x: F.floor(x / 256)
        return _let(moved, lambda f: F.concat_ws(".", whole(f["l"]), f["l"] % 256, whole(f["r"]), f["r"] % 256))

    def date(self, m: F.Column, day: F.Column) -> F.Column:
        number = F.datediff(day, _first_day())
        moved = self.moved("date", F.floor(number / 773), number % 773, F.lit(189), F.lit(773))
        return _let(moved, lambda f: _refill(m, _day_digits(m, F.date_add(_first_day(), (f["l"] * 773 + f["r"]).cast("int")))))

    def mail(self, m: F.Column) -> F.Column:
        keyed = F.sha2(F.concat(self.secret, F.lit("|mail|"), F.lower(m)), 256)
        return _let(keyed, lambda h: F.concat(F.lit("u"), _part(h, 1, 12), F.lit("@"), _part(h, 13, 8), F.lit(".example")))

    def pseudonym(self, m: F.Column) -> F.Column:
        """A struct (kind, new) for the match; kind is NULL where its check fails."""

        def named(kind: str, new: F.Column, valid: F.Column | None = None) -> F.Column:
            found = F.struct(F.lit(kind).alias("kind"), new.alias("new"))
            failed = F.struct(F.lit(None).cast("string").alias("kind"), m.alias("new"))
            return found if valid is None else F.when(valid, found).otherwise(failed)

        def numbers(d: F.Column) -> F.Column:
            area, group, serial = _ssn_parts(d)
            octets = [F.split_part(m, F.lit("."), F.lit(i)).cast("int") <= 255 for i in (1, 2, 3, 4)]
            dated = _let(_day(m), lambda t: named("date", self.date(m, t), t.between(_first_day(), F.lit("2199-12-31").cast("date"))))
            return (
                F.when(m.contains("@"), named("mail", self.mail(m)))
                .when(m.rlike(f"^(?:{_CARD})$"), named("card", self.card(m, d), (_luhn(d, 1) % 10 == 0) & d.rlike("[1-9]")))
                .when(m.rlike(f"^(?:{_SSN})$"), named("ssn", self.ssn(d), area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)))
                .when(m.rlike(f"^(?:{_DATE})$"), dated)
                .when(m.rlike(f"^(?:{_IP})$"), named("ip", self.ip(m), octets[0] & octets[1] & octets[2] & octets[3]))
                .otherwise(named("phone", self.phone(m, d)))
            )

        return _let(_digits(m), numbers)


def _first_day() -> F.Column:
    return F.lit("1800-01-01").cast("date")


def _ssn_parts(d: F.Column) -> tuple[F.Column, F.Column, F.Column]:
    return _part(d, 1, 3).cast("int"), _part(d, 4, 2).cast("int"), _part(d, 6, 4).cast("int")


def _refill(m: F.Column, new: F.Column) -> F.Column:
    """m with its digits replaced, in order, by those of ``new``."""
    so_far = lambda p: F.length(_digits(_part(m, 1, p)))
    own = lambda p: _part(m, p, 1)
    filled = F.transform(F.sequence(F.lit(1), F.length(m)), lambda p: F.when(own(p).between("0", "9"), _part(new, so_far(p), 1)).otherwise(own(p)))
    return F.array_join(filled, "")


def _luhn(digits: F.Column, doubled_from: int) -> F.Column:
    """Luhn sum of the digits; every second one counts double, from this place (0 or 1) from the right."""

    def add(total: F.Column, k: F.Column) -> F.Column:
        digit = _part(digits, F.length(digits) - k, 1).cast("int")
        return total + F.when(k % 2 != doubled_from, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    return F.reduce(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _as_date(text: F.Column, form: str) -> F.Column:
    return F.call_function("try_to_date", text, F.lit(form))


def _day(m: F.Column) -> F.Column:
    """The date that m stands for; month first where both orders are valid."""
    dashed = F.translate(m, "/", "-")
    either = F.coalesce(_as_date(dashed, "MM-dd-yyyy"), _as_date(dashed, "dd-MM-yyyy"))
    fixed = F.when(m.like("____-__-__"), _as_date(m, "yyyy-MM-dd")).when(m.like("____/__/__"), _as_date(m, "yyyy/MM/dd"))
    return fixed.when(m.like("__.__.____"), _as_date(m, "dd.MM.yyyy")).otherwise(either)


def _day_digits(m: F.Column, day: F.Column) -> F.Column:
    year_first = _part(m, 5, 1).isin("-", "/")
    day_first = m.like("__.__.____") | _as_date(F.translate(m, "/", "-"), "MM-dd-yyyy").isNull()
    return F.when(year_first, F.date_format(day, "yyyyMMdd")).when(day_first, F.date_format(day, "ddMMyyyy")).otherwise(F.date_format(day, "MMddyyyy"))


def pseudonymise(docs: DataFrame, settings: Settings, column: str = "text", counts: bool = True) -> DataFrame:
    """All rows and columns with the values in ``column`` replaced; with ``counts`` also ``pii``, a struct of counts by kind.

    The key is a relation of one row that the plan refers to, so neither ``explain`` nor
    event logs show it.
    """
    text = F.col("text")
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    feistel = Feistel(F.col("secret"), settings.rounds)

    def whole(new: F.Column, pieces: F.Column) -> F.Column:
        joined = F.concat(F.array_join(F.transform(new, lambda x, i: F.concat(F.get(pieces, i), x["new"])), ""), F.element_at(pieces, -1))
        of = lambda kind: F.size(F.filter(new, lambda x: x["kind"] == kind))
        tally = [of(kind).cast("long").alias(kind) for kind in KINDS]
        return F.struct(joined.alias("text"), F.struct(*tally).alias("pii"))

    def rewritten(matches: F.Column) -> F.Column:
        none = F.struct(text.alias("text"), F.struct(*[F.lit(0).cast("long").alias(kind) for kind in KINDS]).alias("pii"))
        new = F.transform(matches, feistel.pseudonym)
        return F.when(F.size(matches) == 0, none).otherwise(_let(new, lambda n: _let(F.split(text, PATTERN, -1), lambda pieces: whole(n, pieces))))

    secret = docs.sparkSession.createDataFrame([(settings.key,)], "secret string")
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(f"`{column}`").alias("text"))
    out = source.withColumn("secret", secret.scalar()).select("whole", _let(found, rewritten).alias("out"))
    return out.select(
        *[F.col("out.text").alias(c) if c == column else F.col(f"whole.`{c}`").alias(c) for c in docs.columns],
        *([F.col("out.pii").alias("pii")] if counts else []),
    )


#: Stands in for a secret in the registered queries.
QUERY_SETTINGS = Settings(key="not-a-secret-query-key")


def op10_pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = pseudonymise(docs, QUERY_SETTINGS)
    return out.select("doc_id", "text", *[F.col(f"pii.{kind}").alias(f"n_{kind}") for kind in KINDS])
