r"""Personal data and secrets replaced by keyed surrogates of the same kind and format.

Patterns find e-mail addresses, IP addresses of both versions, card, account and social security
numbers, phone numbers, secrets and names behind a title. A surrogate is drawn from a keyed digest
(HMAC) of the kind and the normalised value, so one value gets one surrogate in the whole corpus and
mentions still agree. It keeps the format: digits stay digits in the same places, letters keep their
case, a phone number its country code, a card number that satisfies the check digit satisfies it
again, an IP address stays one, a name keeps its title, script, gender (of the title, else of its
ending) and number of words; initials stay initials. Phone numbers written in two ways, and an e-mail
address in two cases, are one value; mail domains and the words of a name are values of their own, so
colleagues and relatives stay together. The words of a name are replaced wherever they stand in the
same text as whole words, before or after the title's mention and without one.

Two values must not share a surrogate, and no surrogate may be a value of the corpus (initials aside:
there are too few). Both are checked over all values; the ones that fail are drawn again until none is
left. After a few draws each further one is longer by a sign (of IP addresses those of version 6 get
all their groups), so short formats don't run out of free surrogates; a clash left after ``ROUNDS``
draws is an error. The few redrawn values travel as keyed digests, in a literal up to ``BOUND`` of
them, and by joins beyond it. The values themselves are in the shared folder only while they are
checked.

Only DataFrame functions are used and texts stay in place. Null and empty texts stay as they are,
texts without a match too. Repeated rows are treated alike. All other columns stay; a column with the
name of the count is replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage, forget

BOUND = 10_000
ROUNDS = 60
# Draws that keep the length; every later one is longer by a sign.
SAME_LENGTH = 6

# Titles, by gender.
MEN = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "Г-н", "Κύριος")
WOMEN = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "госпожа", "Г-жа", "Κυρία")
OTHERS = ("Dr", "Prof")

# An address begins at the first letter or digit of its run of signs.
EMAIL = (
    r"(?<![\p{L}\p{N}][._%+'-]{0,8})[\p{L}\p{N}][\p{L}\p{N}._%+'-]*+"
    r"@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
)
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d)"
# Of version 6: eight groups, or fewer around a double colon, with a digit in one of them.
_HEX = "[0-9A-Fa-f]{1,4}"
IP6 = (
    r"(?<![\p{L}\p{N}:.])(?=[A-Fa-f:]*[0-9])"
    rf"(?:{_HEX}(?::{_HEX}){{7}}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?+|::{_HEX}(?::{_HEX}){{1,6}})"
    r"(?![\p{L}\p{N}]|:[\p{L}\p{N}:])"
)
CARD = r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)"
IBAN = r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])"
# Country codes, none of which begins another.
CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
LOCAL = r"(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}"
# Groups of a phone number end before an address, a card or another number.
GROUP = rf"(?![ -](?:{IP}|{CARD}(?![ -]\d{{4}})|{SSN}))[ .-]?\d{{2,4}}"
LATER = r"(?![ .-](?:\d{9}|\d{3}[.-]\d{3}[.-]\d{4}(?!\d)))" + GROUP
# Two zeros in place of the plus sign where groups follow; an area of one digit where two long ones do.
ABROAD = r"(?<![\p{L}\p{N}.,:+#/-])00(?=[1-9]\d{0,2}[ .-]\(?\d)"
AREA = r"(?:\d{2,4}|\d(?=[ .-]\d{3,4}[ .-]?\d{3,4}))"
PHONE = (
    r"(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}"
    rf"|(?:\+|{ABROAD})\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?{AREA}(?:{GROUP})(?:{LATER}){{0,3}}"
    rf"|\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}|{LOCAL})(?!\d)"
)
SECRET = (
    r"(?<=(?i:token|key|secret|password|passwd|pwd)\s{0,3}[=:]\s{0,3}[\"']?)[^\s\"']{8,}+"
    r"|(?<=(?i:password|passwd|pwd)\s{0,3}[=:]\s{0,3}[\"']?)(?=[^\s\"']{0,6}\d)[^\s\"']{4,7}+(?![^\s\"'])"
    r"|(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|AKIA[0-9A-Z]{16})(?![\p{L}\p{N}])"
)
TITLE = r"(?:" + "|".join(sorted(MEN + WOMEN + OTHERS, key=len, reverse=True)) + r")(?:\.?[ \u00a0]|\.?[ \u00a0]?\r?\n[ \u00a0]?)"
# Without the ending of the genitive, quotes or hyphens behind it.
WORD = r"\p{Lu}(?:\p{L}|(?!['’]s(?!\p{L}))['’-](?=\p{L}))++"
INITIAL = r"\p{Lu}\."
NAME = rf"(?<![\p{{L}}\p{{N}}]){TITLE}(?:{INITIAL} ?)*+{WORD}(?: (?:{INITIAL} ?)*+{WORD})*+"
ANY = "|".join((SECRET, EMAIL, IBAN, IP, IP6, SSN, PHONE, CARD, NAME))
# A name's words without a title are its only group.
ALONE = rf"(?:{ANY})|(?<![\p{{L}}\p{{N}}])({WORD})(?!\p{{N}})"
# A text without a digit, an at sign, a title or a secret's name holds nothing to find.
HINT = rf"[0-9@]|{TITLE}\p{{Lu}}|(?i:password|passwd|pwd|token|secret|key)\s{{0,3}}[=:]"

# Sixteen syllables a script; a surrogate name is drawn from them.
SYLLABLES = {
    "latin": "ba co da fe gi ho ju ka lo mi ne pa ri so ta ve".split(),
    "cyrillic": "ба во да ге жи зо ку ла мо ни пе ра си то фа че".split(),
    "greek": "βα γο δα ζε θι κο λυ μα νο ξι πε ρα σι το φα χε".split(),
}
# Endings that tell a gender: of men, of women, of families.
ENDINGS = {"latin": ("n", "na", "r"), "cyrillic": ("н", "на", "р"), "greek": ("ν", "να", "ς")}

# Kinds of the parts of a name.
NAMES = ("family", "given_m", "given_f", "initial")


def _kind(found: Column) -> Column:
    whole = [("email", EMAIL), ("iban", IBAN), ("ip", IP), ("ip6", IP6), ("ssn", SSN), ("card", CARD), ("phone", PHONE), ("name", NAME)]
    kind = F.lit("secret")
    for name, pattern in reversed(whole):
        kind = F.when(found.rlike(rf"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _phone(found: Column) -> Column:
    """The digits, behind a plus sign if the number starts with one or with two zeros for it."""
    digits = _digits(found)
    return F.when(found.startswith("+"), F.concat(F.lit("+"), digits)).when(
        found.startswith("00"), F.concat(F.lit("+"), F.substring(digits, F.lit(3), F.length(digits)))
    ).otherwise(digits)


def _title(found: Column) -> Column:
    return F.regexp_extract(found, f"^{TITLE}", 0)


def _gender(found: Column, word: Column) -> Column:
    title = F.regexp_replace(_title(found), r"[.\s\u00a0]", "")
    ending = F.when(F.lower(word).rlike("[aeаяαη]$"), "f").otherwise("m")
    return F.when(title.isin(*MEN), "m").when(title.isin(*WOMEN), "f").otherwise(ending)


def _words(found: Column) -> Column:
    """Words and initials behind the title."""
    return F.regexp_extract_all(F.substring(found, F.length(_title(found)) + 1, F.length(found)), F.lit(f"{INITIAL}|{WORD}"), 0)


def _values(found: Column) -> Column:
    """The values inside a match, as ``array<struct<kind, value>>``: what a surrogate is drawn for."""
    kind = _kind(found)

    def one(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("kind"), value.alias("value"))

    words = _words(found)
    given = F.transform(words, lambda w, i: F.struct(
        F.when(w.rlike(f"^{INITIAL}$"), "initial").when((i == F.size(words) - 1), "family")
        .otherwise(F.concat(F.lit("given_"), _gender(found, w))).alias("kind"),
        w.alias("value"),
    ))
    mail = F.lower(found)
    plain = F.array(F.struct(kind.alias("kind"), found.alias("value")))
    return (
        F.when(kind == "email", F.array(
            one("email", mail), one("domain", F.substring_index(mail, "@", -1)),
        ))
        .when(kind == "phone", F.array(one("phone", _phone(found))))
        .when(kind == "ip6", F.array(one("ip6", mail)))
        .when(kind.isin("card", "ssn"), F.array(F.struct(kind.alias("kind"), _digits(found).alias("value"))))
        .when(kind == "name", given)
        .otherwise(plain)
    )


def _hmac(key: str, message: Column) -> Column:
    """The keyed digest of a text, in hex digits."""
    block = hashlib.sha256(key.encode()).digest().ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))), 256)


def _tag(key: str, kind: Column, value: Column) -> Column:
    return F.left(_hmac(key, F.concat_ws("\u0001", F.lit("tag"), kind, value)), F.lit(32))


class _Draw:
    """A keyed digest of a value, and streams of signs cut from it."""

    def __init__(self, digest: Column, attempt: Column):
        self.hex = digest
        self.attempt = attempt

    @staticmethod
    def made(key: str, kind: Column, value: Column, attempt: Column, use: Callable[[_Draw], Column]) -> Column:
        """What ``use`` makes of the draw of a value; the digest is worked out once."""
        seed = F.concat_ws("\u0001", kind, value, attempt.cast("string"))
        digest = F.concat(_hmac(key, seed), _hmac(key, F.concat(F.lit("more\u0001"), seed)))
        return F.transform(F.array(digest), lambda d: use(_Draw(d, attempt)))[0]

    def sign(self, at: Column) -> Column:
        return F.substring(self.hex, F.pmod(at, F.lit(128)) + 1, F.lit(1))

    def digit(self, at: Column) -> Column:
        return F.translate(self.sign(at), "abcdef", "012345")

    def letter(self, at: Column) -> Column:
        return F.translate(self.sign(at), "0123456789abcdef", "qrstuvwxyzabcdef")

    def alike(self, value: Column, kept: Column | int = 0, hexed: Column | bool = False) -> Column:
        """``value`` with every digit and letter behind the first ``kept`` signs drawn anew."""
        hexed = F.lit(hexed) if isinstance(hexed, bool) else hexed

        def sign(c: Column, i: Column) -> Column:
            return (
                F.when((i < kept) | ~c.rlike(r"[\p{L}\p{N}]"), c)
                .when(hexed, self.sign(i))
                .when(c.rlike(r"\p{N}"), self.digit(i))
                .when(c.rlike(r"\p{Lu}"), F.upper(self.letter(i)))
                .otherwise(self.letter(i))
            )

        return F.array_join(F.transform(F.split(value, ""), sign), "")

    def more(self, sign: Callable[[Column], Column], value: Column) -> Column:
        """Signs behind those of ``value``, one for every draw beyond ``SAME_LENGTH``."""
        count = self.attempt - SAME_LENGTH
        signs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), count - 1)), lambda i: sign(F.length(value) + i))
        return F.when(count > 0, F.array_join(signs, "")).otherwise("")


def _luhn(digits: Column) -> Column:
    """Sum of the check digit rule over ``digits``; a multiple of ten is right."""
    signs = F.reverse(F.split(digits, ""))
    values = F.transform(signs, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
    ))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _number(draw: _Draw, kind: Column, digits: Column) -> Column:
    """New digits behind a country code; of a card number with the right check digit the last one makes
    it right again."""
    drawn = draw.alike(digits, F.length(F.regexp_extract(digits, CODE, 0)))
    drawn = F.concat(drawn, draw.more(draw.digit, digits))
    start = F.concat(F.left(drawn, F.length(drawn) - 1), F.lit("0"))
    check = F.pmod(-_luhn(start), F.lit(10)).cast("string")
    checked = F.concat(F.left(drawn, F.length(drawn) - 1), check)
    return F.when((kind == "card") & (_luhn(digits) % 10 == 0), checked).otherwise(drawn)


def _word(draw: _Draw, kind: Column, word: Column) -> Column:
    def made(script: str) -> Column:
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        man, woman, family = ENDINGS[script]
        # Three syllables, and one more for every time that the word was drawn again.
        parts = F.transform(F.sequence(F.lit(0), draw.attempt + 2), lambda i: F.element_at(
            syllables, F.conv(draw.sign(i), 16, 10).cast("int") + 1
        ))
        end = F.when(kind == "given_m", man).when(kind == "given_f", woman).otherwise(family)
        return F.initcap(F.concat(F.array_join(parts, ""), end))

    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), made("cyrillic"))
        .when(word.rlike(r"\p{IsGreek}"), made("greek"))
        .otherwise(made("latin"))
    )


def _drawn(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The surrogate of a value."""
    return _Draw.made(key, kind, value, attempt, lambda draw: _made(draw, kind, value))


def _made(draw: _Draw, kind: Column, value: Column) -> Column:
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
        F.pmod(F.conv(F.substring(draw.hex, i * 4 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(254)) + 1
    ).cast("string")), ".")
    last = F.length(value) - F.length(F.substring_index(value, ".", -1))
    domain = F.concat(
        draw.more(draw.letter, value), draw.alike(F.left(value, last)), F.substring_index(value, ".", -1)
    )
    local = F.substring_index(value, "@", 1)
    hexed = value.rlike("^[0-9a-f]+$")
    extra = F.when(hexed, draw.more(draw.sign, value)).otherwise(draw.more(draw.letter, value))
    return (
        F.when(kind == "email", F.concat(draw.alike(local), draw.more(draw.letter, local)))
        .when(kind == "domain", domain)
        .when(kind == "ip", octets)
        .when((kind == "ip6") & (draw.attempt > SAME_LENGTH), F.array_join(
            F.regexp_extract_all(F.left(draw.hex, F.lit(32)), F.lit(".{4}"), 0), ":"
        ))
        .when(kind == "ip6", draw.alike(value, 0, True))
        .when(kind == "iban", F.concat(draw.alike(value, 2), draw.more(draw.digit, value)))
        .when(kind.isin("phone", "card", "ssn"), _number(draw, kind, value))
        .when(kind == "initial", draw.alike(value))
        .when(kind.isin(*NAMES), _word(draw, kind, value))
        .otherwise(F.concat(draw.alike(value, 0, hexed), extra))
    )


def _replaced(key: str, found: Column, attempts: Column | None) -> Column:
    """The text that takes the place of a match."""

    def new(x: Column) -> Column:
        return F.struct(x["kind"].alias("kind"), _drawn(key, x["kind"], x["value"], _tries(key, x, attempts)).alias("new"))

    return F.transform(F.array(F.transform(_values(found), new)), lambda drawn: _written(found, drawn))[0]


def _tries(key: str, x: Column, attempts: Column | None) -> Column:
    """The number of draws that a value has lost."""
    if attempts is None:
        return F.lit(0)
    return F.coalesce(F.try_element_at(attempts, _tag(key, x["kind"], x["value"])), F.lit(0))


def _written(found: Column, drawn: Column) -> Column:
    """The surrogates ``drawn`` for the values of a match, in its format."""
    first = drawn[0]
    # Two zeros in place of a plus sign stay.
    abroad = F.when((first["kind"] == "phone") & found.startswith("00"), "00").otherwise("")
    fresh = F.concat(abroad, _digits(first["new"]))

    def digit(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.left(found, i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(fresh, nth, F.lit(1))).otherwise(c)

    numbers = F.concat(
        F.array_join(F.transform(F.split(found, ""), digit), ""),
        F.substring(fresh, F.length(_digits(found)) + 1, F.length(fresh)),
    )
    local = F.array_join(F.zip_with(
        F.split(F.substring_index(found, "@", 1), ""), F.split(first["new"], ""),
        lambda old, new: F.when(old.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new),
    ), "")
    return (
        F.when(first["kind"] == "email", F.concat(local, F.lit("@"), drawn[1]["new"]))
        .when(first["kind"].isin("phone", "card", "ssn"), numbers)
        .when((first["kind"] == "ip6") & (found == F.upper(found)), F.upper(first["new"]))
        .when(first["kind"].isin(*NAMES), F.concat(
            _title(found), F.array_join(F.zip_with(
                drawn["new"], F.split(F.substring(found, F.length(_title(found)) + 1, F.length(found)), f"{INITIAL}|{WORD}", -1),
                lambda new, between: F.concat(F.coalesce(between, F.lit("")), F.coalesce(new, F.lit(""))),
            ), ""),
        ))
        .otherwise(first["new"])
    )


def _pool(kind: Column) -> Column:
    """Kinds whose values could be taken for each other."""
    return F.when(kind.isin(*NAMES), "name").otherwise(kind)


def _redrawn(values: DataFrame, key: str) -> DataFrame:
    """``tag, attempt`` of the values whose first surrogate was not theirs alone."""
    state = values.withColumn("attempt", F.lit(0))
    for turn in range(ROUNDS):
        drawn = state.withColumn("new", _drawn(key, F.col("kind"), F.col("value"), F.col("attempt")))
        # An e-mail address is its own local part and its domain's surrogate.
        drawn = drawn.withColumn("new", F.when(F.col("kind") == "email", F.concat(
            F.col("new"), F.lit("@"), F.substring_index("value", "@", -1)
        )).otherwise(F.col("new"))).withColumn("pool", _pool(F.col("kind")))
        own = values.select(_pool(F.col("kind")).alias("pool"), F.col("value").alias("new")).distinct()
        users = drawn.groupBy("pool", "new").agg(
            F.min("tag").alias("owner"), F.count(F.lit(1)).alias("users")
        ).join(own.withColumn("taken", F.lit(True)), ["pool", "new"], "left")
        clashes = users.filter("users > 1 or taken").select(
            "pool", "new", F.when(F.col("taken").isNull(), F.col("owner")).alias("owner")
        )
        losers = drawn.join(clashes, ["pool", "new"]).filter("owner is null or tag != owner").select("tag")
        losers = cut_lineage(losers.distinct())
        if losers.isEmpty():
            forget(losers)
            break
        again = losers.withColumn("more", F.lit(1))
        before, state = state, cut_lineage(state.join(again, "tag", "left").withColumn(
            "attempt", F.col("attempt") + F.coalesce("more", F.lit(0))
        ).drop("more"))
        forget(losers, *([before] if turn else []))
    else:
        forget(state)
        raise ValueError(f"surrogates still clash after {ROUNDS} draws")
    again = cut_lineage(state.filter("attempt > 0").select("tag", "attempt"))
    if turn:
        forget(state)
    return again


def _found(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(f"(?:{ANY})"), 0))


def replace_pii(df: DataFrame, key: str, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """Replace what is found in ``text``; ``count`` (None: no such column) gets the number of matches."""
    if not key:
        raise ValueError("a key is needed: without one anybody could draw the same surrogates")
    found = F.explode(_found(F.col(text)))
    values = df.select(found.alias("found")).select(F.explode(_values(F.col("found"))).alias("v"))
    values = cut_lineage(
        values.select(F.col("v.kind").alias("kind"), F.col("v.value").alias("value")).filter("kind != 'initial'")
        .distinct().withColumn("tag", _tag(key, F.col("kind"), F.col("value")))
    )
    try:
        again = _redrawn(values, key)
    finally:
        forget(values)
    listed = again.limit(BOUND + 1).collect()
    if len(listed) <= BOUND:
        forget(again)
        known = F.from_json(F.lit(json.dumps({r.tag: r.attempt for r in listed})), "map<string,int>")
        rows = df.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("old"))
        return _rewritten(rows, df.columns, key, text, count, known if listed else None)
    # More than that: gathered for each text by joins on its values.
    texts = df.select(F.md5(text).alias("print"), F.explode(_found(F.col(text))).alias("found"))
    used = texts.select("print", F.explode(_values(F.col("found"))).alias("v")).select(
        "print", _tag(key, F.col("v.kind"), F.col("v.value")).alias("tag")
    ).distinct().join(again, "tag")
    maps = used.groupBy("print").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "attempt"))).alias("attempts")
    )
    rows = df.select(F.md5(text).alias("print"), F.struct("*").alias("row"), F.col(f"`{text}`").alias("old"))
    joined = rows.join(maps, "print", "left")
    return _rewritten(joined, df.columns, key, text, count, F.col("attempts"))


def _place(names: Column, word: Column) -> Column:
    """Place of the last of the sorted ``names`` whose value is not beyond ``word``; halved step by step."""
    start = F.struct(F.lit(0).alias("low"), F.size(names).alias("high"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(names) + F.lit(1))).cast("int"))

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        right = (at["high"] - at["low"] > 1) & (F.get(names, middle)["value"] <= word)
        left = (at["high"] - at["low"] > 1) & ~right
        return F.struct(
            F.when(right, middle).otherwise(at["low"]).alias("low"),
            F.when(left, middle).otherwise(at["high"]).alias("high"),
        )

    return F.aggregate(steps, start, step, lambda at: at["low"])


def _named(found: Column) -> Column:
    """The words of the names among the matches, one of each, sorted: ``array<struct<value, kind>>``."""
    words = F.flatten(F.transform(
        F.filter(found, lambda m: m.rlike(f"^{TITLE}") & (_kind(m) == "name")), _values
    ))
    words = F.array_sort(F.array_distinct(F.transform(
        F.filter(words, lambda v: v["kind"] != "initial"), lambda v: F.struct(v["value"].alias("value"), v["kind"].alias("kind"))
    )))
    return F.transform(F.array(words), lambda all: F.filter(
        all, lambda v, i: (i == 0) | (F.get(all, i - 1)["value"] != v["value"])
    ))[0]


def _rewritten(
    rows: DataFrame, columns: list[str], key: str, text: str, count: str | None, attempts: Column | None
) -> DataFrame:
    """Rewrite ``rows(row, old[, attempts])`` and take them apart again."""
    old = F.col("old")
    rows = rows.withColumn("found", _found(old))
    titled = F.when(F.exists("found", lambda m: m.rlike(f"^{TITLE}")), _named(F.col("found")))
    rows = rows.withColumn("names", titled)
    some = F.coalesce(F.size("names") > 0, F.lit(False))
    # In a text with names, all words that could be one are matches, too, and told by the group.
    rows = rows.withColumns({
        "all": F.when(some, F.regexp_extract_all(old, F.lit(ALONE), 0)).otherwise(F.col("found")),
        "alone": F.when(some, F.regexp_extract_all(old, F.lit(ALONE), 1)),
    })

    def single(word: Column) -> Column:
        def new(v: Column) -> Column:
            return F.when(v["value"] == word, _Draw.made(
                key, v["kind"], v["value"], _tries(key, v, attempts), lambda draw: _word(draw, v["kind"], word)
            )).otherwise(word)

        known = F.get(F.col("names"), _place(F.col("names"), word))
        return F.transform(F.array(known), new)[0]

    lone = F.coalesce(F.col("alone"), F.array().cast("array<string>"))
    news = F.transform("all", lambda m, i: F.when(
        F.coalesce(F.get(lone, i), F.lit("")) != "", single(m)
    ).otherwise(_replaced(key, m, attempts)))
    rows = rows.withColumn("news", news)
    between = F.when(some, F.split(old, ALONE, -1)).otherwise(F.split(old, f"(?:{ANY})", -1))
    joined = F.array_join(F.zip_with(
        between, F.concat("news", F.array(F.lit(""))), lambda plain, new: F.concat(plain, new)
    ), "")
    replaced = F.size(F.filter(F.zip_with("all", "news", lambda a, b: a != b), lambda x: x))
    new = {text: F.when(F.size("all") > 0, joined).otherwise(old)}
    if count:
        new[count] = F.when(some, replaced).otherwise(F.greatest(F.lit(0), F.coalesce(F.size("found"), F.lit(0))))
    low = {c.lower(): column for c, column in new.items()}
    kept = [low.pop(c.lower(), F.col("row").getField(c)).alias(c) for c in columns]
    return rows.select(*kept, *[column.alias(c) for c, column in new.items() if c.lower() in low])
