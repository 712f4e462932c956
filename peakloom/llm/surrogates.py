"""Surrogates for personal data: keyed replacements of the same type, gender, script and format.

Detected are e-mail addresses, phone numbers, IP addresses, payment card and account numbers, social security
numbers, and names. A name begins with a title, or with a given name of ``given_names``, and takes the whole run of
capitalised words after it, with hyphens, apostrophes, initials and particles (``de la``, ``van``). Only DataFrame
functions are used.

* Every mention has one or more identities, free of its spelling: lower case for an address (an IPv6 address with all
  groups), no blanks for an account number, the last ten digits after country code and trunk zero for a phone number.
  Of a name, the last word is a surname, the first of several and every
  further given name of the list are given names, all others surnames; parts joined by hyphens count one by one.
  All mentions of an identity get the same surrogate, written the way each mention is written (separators, country
  code, trunk zero, capitals, title, particles, ``O'``); an initial becomes that of the new surname, and a shortened
  IPv6 address is replaced by a full one.
* A surrogate is drawn from a keyed SHA-256 of identity and attempt. It keeps lengths, digits, letters and capitals;
  an address goes to a reserved domain, an IP address to a reserved range, a valid card number stays valid, a given
  name keeps gender and script.
* Drawn surrogates are checked over the whole corpus: one that equals a real identity, or that several identities
  have drawn, is drawn again by all but the smallest of them, until all are distinct. Later attempts draw from
  larger ranges.

Not detected are names without title that do not begin with a listed given name (``Zebulon Pike``, a surname or given
name alone, surname first), names of which the list leaves the given name out as a common word (``Will Smith``),
names in lower case or in scripts without capitals, the part of a name after a line break or a second blank, and
titles that are not in ``TITLES`` or followed by a lower-case addition (``Dr. med.``). A given name that is not listed
has the gender of its title, so it counts as another one after ``Mrs`` than after ``Dr``. A run of capitalised words
is taken whole even if its end is no name (``John Smith Avenue``).

Of numbers, not detected are phone numbers without ``+`` other than 3-3-4 digits, ten digits in a row from 2 on, and
ten or eleven digits with a trunk zero (and those if more digits follow, or if they look like a date); shortened IPv6
without any digit; account numbers in groups of a country that is not in ``IBAN_LENGTHS`` or in other groups than
four; social security numbers without hyphens; and cards in groups other than 4-4-4-4, 4-6-5 and 4-6-4 (of 19 digits
in groups the last three stay). Any number of these shapes is replaced, whatever it means.

Identities are counted before they move, so a mention in a third of all rows is one row of the check. Only rows with
mentions are joined, by the MD5 of their text; the surrogates of a text are one small map. Other rows never move.

Defined cases: null and empty texts stay as they are, so do texts without mentions; repeated rows get equal
results; other columns pass through unchanged, ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.llm.columns import unused, without
from peakloom.llm.given_names import NAMES
from peakloom.session import Scratch

# Titles by gender, given names by gender and script, syllables of surnames by script.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    ("f", "latin"): ["Anna", "Clara", "Elena", "Emma", "Eva", "Hanna", "Irene", "Julia", "Laura", "Lucia", "Maria", "Marta", "Nina", "Olivia", "Paula", "Sofia"],
    ("m", "latin"): ["Adam", "Bruno", "Daniel", "David", "Felix", "Hugo", "James", "John", "Leon", "Lucas", "Martin", "Oscar", "Paul", "Peter", "Simon", "Thomas"],
    ("f", "cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Сергей"],
    ("f", "greek"): ["Άννα", "Ειρήνη", "Ελένη", "Μαρία", "Σοφία", "Ζωή"],
    ("m", "greek"): ["Γιώργος", "Δημήτρης", "Νίκος", "Παύλος", "Πέτρος", "Φίλιππος"],
}
SYLLABLES = {
    "latin": ["ba", "do", "fen", "gar", "hol", "ka", "len", "mor", "nel", "per", "ros", "san", "tor", "ul", "ver", "win"],
    "cyrillic": ["ба", "ве", "го", "дар", "ко", "ла", "мо", "но", "пе", "ро", "са", "ту"],
    "greek": ["βα", "γο", "δα", "κο", "λα", "μα", "νι", "πα", "ρο", "σα", "το", "φι"],
}

_LETTERS = {"cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

# Detected are the surrogates' names and the far longer list.
LISTED = {g: NAMES[g] | {n for k, names in GIVEN.items() if k[0] == g for n in names} for g in NAMES}


def _trie(words) -> str:
    """A pattern of all words that tries every common beginning once."""
    ends: dict[str, set] = {}
    for w in words:
        ends.setdefault(w[:1], set()).add(w[1:])
    optional = ends.pop("", None) is not None
    parts = [c + _trie(rest) for c, rest in sorted(ends.items())]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)}){'?' if optional else ''}"


_given = _trie(set().union(*LISTED.values()))
_title = "|".join(sorted((t for titles in TITLES.values() for t in titles), reverse=True))
_letter = "[\\p{L}\\p{M}]"
_particle = "(?:(?:v[ao]n|de)(?: (?:der|den|dem|la|las|los|het))?|del|della|di|da|dos|das|du|ten|ter|bin|ibn|al|el) "
# Possessive, so that Java matches runs of any length without recursion
_word = f"(?!(?:{_title})(?!{_letter}))(?:\\p{{Lu}}['’])?\\p{{Lu}}{_letter}++(?:(?:['’]|-(?:\\p{{Lu}}['’])?)\\p{{Lu}}{_letter}++)*+"
_step = f"(?:(?:(?:\\p{{Lu}}\\.){{1,4}}|\\p{{Lu}}) )*+(?:{_particle})?{_word}"
_octet = "(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)"
_group = "[0-9A-Fa-f]{1,4}"
_mail, _host = "[\\p{L}\\p{M}\\p{Nd}._%+-]", "[\\p{L}\\p{M}\\p{Nd}-]"
# Eight groups, or seven at most with one ``::`` and any digit
_ip6 = (
    f"(?<![\\w:])(?:(?:{_group}:){{7}}{_group}|(?=[A-Fa-f:]*[0-9])(?=[0-9A-Fa-f:]*::)(?!(?:::)?(?:{_group}:++){{7}}{_group})"
    f"(?:(?:{_group}(?::{_group}){{0,6}})?::{_group}(?::{_group}){{0,6}}|{_group}(?::{_group}){{0,6}}::))(?![\\w:]|\\.\\d)"
)
# Lengths of account numbers by country, for those in groups of four
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_grouped = "|".join(
    f"(?:{'|'.join(c.split())})\\d{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, c in IBAN_LENGTHS.items()
)
# Without plus: a trunk zero, in brackets or not, and ten or eleven digits in all, but no date; or ten digits in a row
_national = (
    "(?=[(]?0[1-9](?:[ .()/-]{0,2}\\d){8,9}(?![ .-]?\\d|\\w))(?!\\d{2}[./-]\\d{2}[./-](?:19|20)\\d{2}(?!\\d))"
    "(?:(?:\\(0\\d{1,5}\\) ?|0\\d{1,5}[ ./-])\\d{2,8}(?:[ .-]\\d{2,8}){0,4}|0\\d{9,10})|[2-9]\\d{9}"
)
PATTERNS = {
    "email": f"(?<!{_mail})(?:{_mail}){{1,64}}+@(?:(?:{_host}){{1,63}}\\.){{1,8}}\\p{{L}}{{2,24}}(?!{_host})",
    "iban": f"(?<!\\w)(?=[A-Z]{{2}}\\d{{2}})(?:[A-Z]{{2}}\\d{{2}}[A-Z0-9]{{11,30}}|{_grouped})(?!\\w)",
    "ip": f"(?<![\\w.])(?<!(?i:version|release|build|firmware)[ :]{{1,2}})(?<!(?i:ver)\\.? )(?:{_octet}\\.){{3}}{_octet}(?!\\w|\\.\\d)",
    "ip6": _ip6,
    "ssn": "(?<![\\w-])\\d{3}-\\d{2}-\\d{4}(?![\\w-])",
    "card": "(?<![\\w.])(?:\\d{13,19}|\\d{4}(?:[ -]\\d{4}){3}|\\d{4}[ -]\\d{6}[ -]\\d{4,5})(?!\\w)",
    "phone": "(?<![\\w+])(?:\\+(?=(?:[ .()-]{0,2}\\d){8})\\d{1,3}[ .-]?(?:\\(\\d{1,4}\\)[ .-]?)?\\d{1,12}(?:[ .-]\\d{2,8}){0,4}"
    f"|(?:\\(\\d{{3}}\\) ?|\\d{{3}}[ .-])\\d{{3}}[ .-]\\d{{4}}|{_national})(?!\\w)",
    "name": f"(?=\\p{{Lu}})(?<!\\p{{L}})(?:(?:(?:{_title})\\.? )++{_step}"
    f"|{_given}(?!{_letter})(?:-\\p{{Lu}}{_letter}++)*+ {_step})(?: {_step})*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
NUMBERS = "|".join(f"(?:{p})" for n, p in PATTERNS.items() if n not in ("email", "name"))


def has_mention(text: Column) -> Column:
    """Whether there is any mention; cheap tests come first, as most texts have no ``@`` and few digits."""
    return F.coalesce(
        (text.contains("@") & text.rlike(PATTERNS["email"]))
        | (text.rlike("[0-9]") & text.rlike(NUMBERS))
        | text.rlike(PATTERNS["name"]),
        F.lit(False),
    )


def _whole(kind: str) -> str:
    """The pattern of a kind for a mention on its own; lookarounds hold at its ends."""
    return f"^(?:{PATTERNS[kind]})$"


def _kind(mention: Column) -> Column:
    names = list(PATTERNS)
    out = F.when(mention.rlike(_whole(names[0])), names[0])
    for name in names[1:]:
        out = out.when(mention.rlike(_whole(name)), name)
    return out.otherwise("phone")  # the count of digits that follow a plus sign may look beyond the mention


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _script(name: Column) -> Column:
    return (
        F.when(name.rlike("^\\p{IsCyrillic}"), "cyrillic").when(name.rlike("^\\p{IsGreek}"), "greek").otherwise("latin")
    )


def _first(name: Column) -> Column:
    """The first part of a name with hyphens, in lower case."""
    return F.substring_index(F.lower(name), "-", 1)


def _is_name(word: Column) -> Column:
    """Whether a word of a name is neither particle nor initial."""
    return word.rlike(f"^(?:\\p{{Lu}}['’])?\\p{{Lu}}{_letter}")


def _core(part: Column) -> Column:
    """A part of a name without ``O'``."""
    return F.regexp_replace(part, "^\\p{Lu}['’](?=\\p{Lu})", "")


def _given_table(spark: SparkSession, scratch: Scratch) -> DataFrame:
    """(first, listed) of every given name in lower case, written, so that the planner knows it is small."""
    gender: dict[str, str] = {}
    for g in "nmf":  # a name of several genders counts as the last of them
        gender |= dict.fromkeys((n.lower() for n in LISTED[g]), g)
    return scratch.save(spark.createDataFrame(sorted(gender.items()), "first string, listed string"), "given")


def _name_parts(names: DataFrame, given: DataFrame) -> DataFrame:
    """Names (m) to one row for each part of a word that is joined by hyphens: (m, titles, i, k, part, identity).

    Particles and initials have no identity.
    """
    titled = names.select("m", F.regexp_extract("m", f"^(?:(?:{_title})\\.? )+", 0).alias("titles"))
    words = titled.select("m", "titles", F.split(F.col("m").substr(F.length("titles") + 1, F.length("m")), " ").alias("words"))
    words = words.select("m", "titles", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    words = words.withColumn("first", _first(F.col("word"))).join(given, "first", "left")
    title = F.regexp_extract("titles", f"^({_title})", 1)
    gender = F.when(F.col("listed").isin("f", "m"), F.col("listed")).when(title.isin(TITLES["f"]), "f").when(title.isin(TITLES["m"]), "m")
    is_given = (F.col("i") < F.col("n") - 1) & ((F.col("i") == 0) | F.col("listed").isNotNull())
    whole = F.when(_is_name(F.col("word")), F.split("word", "-")).otherwise(F.array("word"))
    parts = words.select(
        "m", "titles", "i", F.coalesce(gender, F.lit("n")).alias("gender"), is_given.alias("is_given"),
        _is_name(F.col("word")).alias("named"), F.posexplode(whole).alias("k", "part"),
    )
    core = _core(F.col("part"))
    given_name = F.concat_ws(":", F.lit("given"), "gender", _script(core), F.lower(core))
    surname = F.concat_ws(":", F.lit("surname"), _script(core), F.lower(core))
    identity = F.when(F.col("named"), F.when(F.col("is_given"), given_name).otherwise(surname))
    return parts.select("m", "titles", "i", "k", "part", identity.alias("identity"))


def _eight_groups(address: Column) -> Column:
    """A version 6 address in lower case with all its groups, without zeros before them."""

    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda g: g != "")

    left = groups(F.substring_index(address, "::", 1))
    right = F.when(address.contains("::"), groups(F.substring_index(address, "::", -1))).otherwise(
        F.array().cast("array<string>")
    )
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0)))
    every = F.transform(F.concat(left, zeros, right), lambda g: F.regexp_replace(F.lower(g), "^0+(?=.)", ""))
    return F.array_join(every, ":")


def _identity(mention: Column, kind: Column) -> Column:
    """The identity behind a mention that is no name; null if its check sum says that it is none of its kind."""
    digits = _digits(mention)
    national = _digits(F.regexp_replace(mention, "^\\+\\d{1,3}(?=[ .(-])", ""))
    national = F.regexp_replace(national, "^0+(?=\\d)", "")
    account = F.lower(F.regexp_replace(mention, " ", ""))
    value = (
        F.when(kind == "phone", F.regexp_extract(national, "(\\d{1,10})$", 1))
        .when(kind == "card", F.when(_luhn(digits) % 10 == 0, digits))
        .when(kind == "ssn", digits)
        .when(kind == "iban", F.when(_mod97(account) == 1, account))
        .when(kind == "ip6", _eight_groups(mention))
        .otherwise(F.lower(mention))
    )
    return F.when(value.isNotNull(), F.concat_ws(":", kind, value))


def _mod97(account: Column) -> Column:
    """Check sum of an account number in lower case: 1 if it is valid."""
    turned = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.instr(F.lit("0123456789abcdefghijklmnopqrstuvwxyz"), c) - 1
        return F.pmod(rest * F.when(value > 9, 100).otherwise(10) + value, F.lit(97))

    return F.aggregate(_characters(turned), F.lit(0), step)


def _byte(stream: Column, i: Column) -> Column:
    """Byte i of a hexadecimal stream, from its start again after 32."""
    return F.conv(F.substring(stream, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _characters(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))


def _alike(value: Column, stream: Column) -> Column:
    """A value of the same length, with digits for digits and letters for letters."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        return (
            F.when(c.rlike("[0-9]"), (b % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(b % 26 + 97))
            .when(c.rlike("[A-Z]"), F.char(b % 26 + 65))
            .when(c.rlike("\\p{IsCyrillic}"), F.substring(F.lit(_LETTERS["cyrillic"]), b % 32 + 1, F.lit(1)))
            .when(c.rlike("\\p{IsGreek}"), F.substring(F.lit(_LETTERS["greek"]), b % 24 + 1, F.lit(1)))
            .when(c.rlike("\\p{L}"), F.char(b % 26 + 97))
            .otherwise(c)
        )

    return F.array_join(F.transform(_characters(value), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the card check; valid numbers have a multiple of ten."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(_characters(F.reverse(digits)), value), F.lit(0), lambda a, b: a + b)


def _draw(identity: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an identity at an attempt, without its kind."""
    stream = F.sha2(F.concat_ws("|", F.lit(key), identity, attempt.cast("string")), 256)
    kind = F.substring_index(identity, ":", 1)
    value = F.regexp_replace(identity, "^[^:]*:", "")
    later = attempt > 0
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    own_domain = F.regexp_extract(domain, "^(.*?)\\.?[^.]+\\.[^.]+$", 1)
    domain_stream = F.sha2(F.concat_ws("|", F.lit(key), own_domain), 256)
    email = F.concat(
        _alike(local, stream),
        F.when(later, F.substring(stream, 40, 6)).otherwise(""),
        F.lit("@"),
        F.when(own_domain != "", F.concat(_alike(own_domain, domain_stream), F.lit("."))).otherwise(""),
        F.lit("example."),
        F.substring_index(domain, ".", -1),
    )
    octets = [_byte(stream, F.lit(i)) for i in range(4)]
    ip = F.concat_ws(".", (octets[0] % 16 + 240).cast("string"), *[o.cast("string") for o in octets[1:]])
    ip6 = F.concat(
        F.lit("2001:db8"),
        *[F.concat(F.lit(":"), F.regexp_replace(F.substring(stream, 4 * i + 1, 4), "^0", "f")) for i in range(6)],
    )
    drawn = _alike(value, stream)
    phone = F.concat((_byte(stream, F.lit(31)) % 8 + 2).cast("string"), F.substring(drawn, 2, 40))
    card = F.concat(F.substring(value, 1, 1), F.substring(drawn, 2, 40))
    open_card = F.concat(card.substr(F.lit(1), F.length(card) - 1), F.lit("0"))
    check = F.pmod(-_luhn(open_card), F.lit(10)).cast("string")
    card = F.concat(card.substr(F.lit(1), F.length(card) - 1), check)
    country, account = F.substring(value, 1, 2), F.substring(drawn, 5, 40)
    checked = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    iban = F.concat(country, checked, account)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "ip6", ip6)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(drawn, 2, 8)))
        .when(kind == "iban", iban)
        .when(kind == "given", _given_name(value, attempt, stream))
        .otherwise(_surname(value, attempt, stream))
    )


def _pick(options: list[str], stream: Column, place: int) -> Column:
    number = F.conv(F.substring(stream, 1 + 4 * (place % 15), 4), 16, 10).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), F.pmod(number, F.lit(len(options))) + 1)


def _given_name(value: Column, attempt: Column, stream: Column) -> Column:
    """``value`` is gender:script:name; later attempts draw double and longer names."""
    out = None
    either = F.when(_byte(stream, F.lit(30)) % 2 == 0, "f").otherwise("m")
    gender, script = F.substring_index(value, ":", 1), F.substring_index(F.substring_index(value, ":", 2), ":", -1)
    # gender unknown: the lists take turns by the drawn number
    gender = F.when(gender == "n", either).otherwise(gender)
    for (g, s), names in GIVEN.items():
        names = [n.lower() for n in names]
        more = [F.when(attempt > 2 * i, _pick(names, stream, 1 + i)) for i in range(7)]
        one = F.concat_ws("-", _pick(names, stream, 0), *more)
        fits = (gender == g) & (script == s)
        out = F.when(fits, one) if out is None else out.when(fits, one)
    return F.concat_ws(":", gender, script, out)


def _surname(value: Column, attempt: Column, stream: Column) -> Column:
    """``value`` is script:name; each attempt draws one more syllable."""
    out = None
    for script, syllables in SYLLABLES.items():
        parts = [_pick(syllables, stream, i) for i in range(3)]
        more = [F.when(attempt > i, _pick(syllables, stream, 3 + i)) for i in range(8)]
        fits = value.startswith(f"{script}:")
        name = F.concat_ws("", *parts, *more)
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return F.concat_ws(":", F.substring_index(value, ":", 1), out)


def _capital(name: Column) -> Column:
    """Capitals at the beginning of each part of a name."""
    parts = F.transform(F.split(name, "-"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 60)))
    return F.array_join(parts, "-")


def _filled(mention: Column, digits: Column) -> Column:
    """The mention with its last digits replaced by ``digits``, separators as they are."""
    kept = F.length(_digits(mention)) - F.length(digits)
    every = F.concat(F.substring(_digits(mention), F.lit(1), kept), digits)

    def one(c: Column, i: Column) -> Column:
        place = F.length(_digits(F.substring(mention, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(every, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_characters(mention), one), "")


def _rendered_names(parts: DataFrame) -> DataFrame:
    """(m, r) of names whose parts (m, titles, i, k, part) have their surrogate: words and hyphens put together."""
    new = F.substring_index("surrogate", ":", -1)
    listed = parts.select("m", "titles", F.struct("i", "k", "part", new.alias("new")).alias("p"))
    names = listed.groupBy("m", "titles").agg(F.sort_array(F.collect_list("p")).alias("parts"))
    surname = F.upper(F.substring(F.element_at("parts", -1)["new"], 1, 1))

    def one(p: Column) -> Column:
        part, new = p["part"], p["new"]
        core = _core(part)
        capitals = (part == F.upper(part)) & (F.length(core) > 1)
        before = F.substring(part, F.lit(1), F.length(part) - F.length(core))
        named = F.concat(before, F.when(capitals, F.upper(new)).otherwise(_capital(new)))
        initial = F.regexp_replace(part, F.lit("\\p{Lu}"), F.col("surname"))
        text = F.when(new.isNotNull(), named).when(part.rlike("^\\p{Lu}"), initial).otherwise(part)
        return F.concat(F.when(p["k"] > 0, "-").when(p["i"] > 0, " ").otherwise(""), text)

    names = names.withColumn("surname", surname)
    return names.select("m", F.concat("titles", F.array_join(F.transform("parts", one), "")).alias("r"))


def _rendered(mention: Column, kind: Column, found: Column) -> Column:
    """The surrogate of a mention that is no name, written as the mention is."""
    upper = (mention == F.upper(mention)) & mention.rlike("\\p{Lu}\\P{Ll}*\\p{Lu}")
    grouped = F.regexp_replace(F.upper(found), "(.{4})(?=.)", "$1 ")
    return (
        F.when(kind.isin("phone", "card", "ssn"), _filled(mention, found))
        .when((kind == "iban") & mention.contains(" "), grouped)
        .when(kind.isin("email", "ip6", "iban") & upper, F.upper(found))
        .otherwise(found)
    )


def _replacements(mentions: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(m, r) of distinct mentions (m); those whose check sum fails have no row.

    Every step is written, so that none is repeated inside another and plans stay small.
    """
    typed = scratch.save(mentions.select("m", _kind(F.col("m")).alias("kind")), "typed")
    given = _given_table(mentions.sparkSession, scratch)
    parts = scratch.save(_name_parts(typed.where("kind = 'name'").select("m"), given), "parts")
    others = typed.where("kind <> 'name'").select("m", "kind", _identity(F.col("m"), F.col("kind")).alias("identity"))
    others = scratch.save(others.where(F.col("identity").isNotNull()), "others")
    every = parts.where(F.col("identity").isNotNull()).select("identity").unionAll(others.select("identity"))
    drawn = _surrogates(scratch.save(every.distinct(), "distinct"), key, scratch)
    names = _rendered_names(parts.join(drawn, "identity", "left"))
    rest = others.join(drawn, "identity").select("m", _rendered(F.col("m"), F.col("kind"), F.col("surrogate")).alias("r"))
    return scratch.save(names.unionAll(rest), "rendered")


def _surrogates(identities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(identity, surrogate) of distinct identities, all surrogates distinct and none a real identity."""
    kind = F.substring_index("identity", ":", 1)
    waiting, done, attempt = identities, None, 0
    while True:
        drawn = waiting.select("identity", _draw(F.col("identity"), F.lit(attempt), key).alias("surrogate"))
        drawn = scratch.save(drawn.withColumn("taken", F.concat_ws(":", kind, "surrogate")), "drawn")
        first = drawn.groupBy("taken").agg(F.min("identity").alias("identity"))
        free = first.join(identities.select(F.col("identity").alias("taken")), "taken", "left_anti")
        if done is not None:
            free = free.join(done.select("taken"), "taken", "left_anti")
        new = scratch.save(drawn.join(free.select("identity"), "identity", "left_semi"), "new")
        done = new if done is None else scratch.save(done.unionAll(new), "done")
        waiting = scratch.save(drawn.join(new.select("identity"), "identity", "left_anti").select("identity"), "waiting")
        if waiting.isEmpty():
            return done.select("identity", "surrogate")
        attempt += 1
        if attempt > 60:
            raise RuntimeError("surrogates stay short of identities; widen their ranges")


# Mentions are put between marks of the private use area; what of it stands in a text is escaped.
_ESCAPE, _MARK = "\ue000", "\ue001"
_ESCAPES = [(_ESCAPE, _ESCAPE + "\ue003"), (_MARK, _ESCAPE + "\ue002")]


def _pieces(text: Column) -> Column:
    """A text cut before and after each mention: what lies between mentions at even places, mentions at odd ones."""
    for c, escaped in _ESCAPES:
        text = F.replace(text, F.lit(c), F.lit(escaped))
    return F.split(F.regexp_replace(text, ANY, f"{_MARK}$0{_MARK}"), _MARK, -1)


def _plain(piece: Column) -> Column:
    for c, escaped in reversed(_ESCAPES):
        piece = F.replace(piece, F.lit(escaped), F.lit(c))
    return piece


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with every mention of personal data in ``text`` replaced; ``n_mentions`` counts them."""
    scratch = Scratch(docs.sparkSession)
    docs = without(docs, "n_mentions")
    names = docs.columns
    row, pieces, made, new = unused(docs, "row", "pieces", "made", "new")
    hit = has_mention(F.col(text))
    others = [c for c in names if c.lower() != text.lower()]
    found = docs.where(hit).select(*others, F.md5(F.col(text).cast("binary")).alias(row), _pieces(F.col(text)).alias(pieces))
    found = scratch.save(found, "found")
    mentions = F.array_distinct(F.filter(pieces, lambda _, i: i % 2 == 1))
    pairs = scratch.save(found.select(F.col(row).alias("row"), F.explode(mentions).alias("m")).distinct(), "pairs")
    rendered = _replacements(pairs.select("m").distinct(), key, scratch)
    maps = pairs.join(rendered, "m").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("m", "r"))).alias(made))
    maps = scratch.save(maps.withColumnRenamed("row", row), "maps")

    def one(piece: Column, i: Column) -> Column:
        return F.when(i % 2 == 1, F.coalesce(F.element_at(made, piece), piece)).otherwise(_plain(piece))

    count = F.size(F.filter(pieces, lambda p, i: (i % 2 == 1) & F.coalesce(F.map_contains_key(made, p), F.lit(False))))
    done = found.join(maps, row, "left").withColumn(new, F.array_join(F.transform(pieces, one), ""))
    fill = {text.lower(): F.col(new)}
    if "n_chars" in (c.lower() for c in names):
        fill["n_chars"] = F.length(new).cast(docs.schema[next(c for c in names if c.lower() == "n_chars")].dataType)
    done = done.select(*[fill[c.lower()].alias(c) if c.lower() in fill else F.col(c) for c in names], count.cast("long").alias("n_mentions"))
    rest = docs.where(~hit).select(*names, F.lit(0).cast("long").alias("n_mentions"))
    return done.unionAll(rest)
