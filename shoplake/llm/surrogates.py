"""PII surrogates: detected entities are replaced by keyed, type-consistent stand-ins.

Entities are found by one regular expression. Every distinct entity (type and normal form) gets a
surrogate derived from a keyed hash: the same entity has the same surrogate everywhere, in the format of
each mention; names keep gender (from the title), script and letter case word by word. Surrogates that
meet another entity's surrogate or any original value are drawn again, so that distinct entities stay
distinct. All of it is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import materialize

MALE = ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Signor")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "Signora")
NEUTRAL = ("Dr", "Prof")
CYRILLIC_MALE, CYRILLIC_FEMALE = ("господин", "г-н"), ("госпожа", "г-жа")
MALE, FEMALE = MALE + CYRILLIC_MALE, FEMALE + CYRILLIC_FEMALE

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
# A possessive 's is not part of the name.
_WORD = r"\p{Lu}(?:[\p{L}-]|['’](?!s(?!\p{L})))+"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
IP = rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"
IPV6 = (r"(?<![\w:.])(?:(?:H:){7}H|(?=[0-9A-Fa-f:]*\d)(?:(?:H:){6}:H|(?:H:){5}(?::H){1,2}|(?:H:){4}(?::H){1,3}|(?:H:){3}(?::H){1,4}"
        r"|(?:H:){2}(?::H){1,5}|H:(?::H){1,6}|:(?::H){1,7}|(?:H:){1,7}:))(?![\w:]|\.\d)").replace("H", "[0-9A-Fa-f]{1,4}")
IP = rf"{IPV6}|{IP}"
# In groups of four the last whole group has a digit, and eight digits follow the check digits.
IBAN = (r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?=(?:[ A-Z]{0,5}\d){8})(?: [A-Z0-9]{4}){2,6} (?=[A-Z]*\d)[A-Z0-9]{4}"
        r"(?: (?=[A-Z]*\d)[A-Z0-9]{1,3})?|(?: \d{4}){2} \d{3})\b")
CARD = r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = (r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
         r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.+-])(?:1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
         r"|(?<![\w.+:/-])(?:\(0\d{1,4}\)|0\d{1,4})[ .-]\d{3,4}[ .-]?\d{3,4}(?![\w-])|(?<![\w.+:/-])0\d(?:[ .-]\d{2}){4}(?![\w-])")
SECRET_WORD = r"(?i:password|passwd|pwd|secret|token|api_?key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
SECRET = (r"\bAKIA[0-9A-Z]{16}\b|\b(?:sk|ghp|gho|xoxb|xoxp)[-_][A-Za-z0-9_-]{16,}"
          rf"|{SECRET_WORD}(?=[A-Za-z+/_-]*\d)[A-Za-z0-9+/_-]{{6,}}={{0,2}}")
TITLE = rf"(?:{_TITLES})\.? (?=\p{{Lu}})"
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? {_WORD}(?: {_WORD}){{0,2}}"
ENTITY = "|".join((EMAIL, IP, SECRET, IBAN, CARD, SSN, PHONE, NAME))
# One word that may be a name; a possessive or single letter after a hyphen or apostrophe is not part of it.
CAPITALISED = r"\p{Lu}\p{L}*+(?:[-'’](?!s(?!\p{L}))\p{L}{2,}+)*+(?!\p{N})"
ENTITY_OR_WORD = rf"{ENTITY}|(?<![\p{{L}}\p{{N}}]){CAPITALISED}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = "0123456789abcdef"
CYRILLIC, GREEK = "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"


@dataclass(frozen=True)
class Script:
    """Letters from which name words are put together."""

    pattern: str
    consonants: str
    vowels: str
    female_end: str
    male_end: str


LATIN_SCRIPT = Script("", "bdfghjklmnprstvz", "aeiou", "a", "n")
SCRIPTS = (Script(r"\p{IsCyrillic}", "бвгдзклмнпрст", "аеиоу", "а", "н"),
           Script(r"\p{IsGreek}", "βγδζκλμνπρστ", "αειο", "α", "ς"))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once and referred to by name."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _find(entries: Column, field: str, value: Column) -> Column:
    """The first of the entries (structs sorted by ``field``) that has this value there, or null: a binary search, as
    a look-up in a map takes time in proportion to its size."""
    size = F.size(entries)

    def halved(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
        right = F.get(entries, middle)[field] < value
        return F.when(a["low"] >= a["high"], a).when(right, F.struct((middle + 1).alias("low"), a["high"].alias("high"))).otherwise(
            F.struct(a["low"].alias("low"), middle.alias("high")))

    place = F.aggregate(F.sequence(F.lit(1), F.length(F.bin(size.cast("long")))),
                        F.struct(F.lit(0).alias("low"), size.alias("high")), halved, lambda a: a["low"])
    return _let(F.get(entries, place), lambda found: F.when(found[field] == value, found))


def _pick(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), (number % len(alphabet) + 1).cast("int"), F.lit(1))


def _stream(key: str, kind: Column, norm: Column, attempt: Column, length: Column) -> Column:
    """Hex digits of a keyed hash, two for each of ``length`` characters and some more."""
    blocks = F.sequence(F.lit(0), F.floor(length / 32).cast("int") + 1)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(
        F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string"), b.cast("string")), 256)), "")


def _byte(stream: Column, place: Column) -> Column:
    """The place-th byte (from 1) of a hex stream."""
    return F.conv(F.substring(stream, (place * 2 - 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _each(text: Column, function) -> Column:
    """Join of function(character, its place from 1) over the text; the empty text stays."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    return F.array_join(F.transform(places, lambda i: function(F.substring(text, i.cast("int"), F.lit(1)), i)), "")


def _between(c: Column, low: str, high: str) -> Column:
    return (c >= low) & (c <= high)


def _same_class(text: Column, stream: Column, hexadecimal: Column) -> Column:
    """Every letter and digit replaced by one of its class and script; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        return (F.when(hexadecimal & (_between(c, "0", "9") | _between(c, "a", "f")), _pick(HEX, b))
                .when(hexadecimal & _between(c, "A", "F"), _pick(HEX.upper(), b))
                .when(_between(c, "0", "9"), _pick(DIGITS, b))
                .when(_between(c, "a", "z"), _pick(LOWER, b)).when(_between(c, "A", "Z"), _pick(UPPER, b))
                .when(_between(c, "а", "я"), _pick(CYRILLIC, b)).when(_between(c, "А", "Я"), _pick(CYRILLIC.upper(), b))
                .when(_between(c, "α", "ω"), _pick(GREEK, b)).when(_between(c, "Α", "Ω"), _pick(GREEK.upper(), b))
                .when(c.rlike(r"[\p{L}\p{N}]"), _pick(LOWER, b)).otherwise(c))

    return _each(text, one)


def _luhn(digits: Column) -> Column:
    """Sum of the check: every second digit from the right doubled, less 9 if above 9."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i.cast("int"), F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _mod97(text: Column) -> Column:
    """The text's number modulo 97, letters standing for 10 to 35."""

    def add(rest: Column, c: Column) -> Column:
        digit = F.instr(F.lit(DIGITS + UPPER), F.upper(c)) - 1
        return F.pmod(rest * F.when(digit > 9, 100).otherwise(10) + digit, F.lit(97)).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _title_gender(mention: Column) -> Column:
    title = F.regexp_extract(mention, r"^(.*?)\.? ", 1)
    return F.when(title.isin(*MALE), F.lit("m")).when(title.isin(*FEMALE), F.lit("f")).otherwise(F.lit("x"))


def kind_of(mention: Column) -> Column:
    whole = lambda p: mention.rlike(f"^(?:{p})$")
    return (F.when(mention.contains("@"), F.lit("email")).when(whole(IP), F.lit("ip"))
            .when(whole(SECRET), F.lit("secret")).when(whole(IBAN), F.lit("iban")).when(whole(CARD), F.lit("card"))
            .when(whole(SSN), F.lit("ssn")).when(whole(PHONE), F.lit("phone")).otherwise(F.lit("name")))


def _secret_value(mention: Column) -> Column:
    return F.regexp_replace(mention, f"^{SECRET_WORD}", "")


def _canonical_ip(ip: Column) -> Column:
    """IPv4 as it is; IPv6 in lower case with all eight groups and no leading zeros."""
    halves = F.split(F.lower(ip), "::")
    groups = lambda h: F.filter(F.split(h, ":"), lambda x: x != "")
    left, right = groups(halves[0]), F.when(F.size(halves) > 1, groups(F.get(halves, 1))).otherwise(F.array().cast("array<string>"))
    whole = _let(F.struct(left.alias("l"), right.alias("r")), lambda h: F.concat(h["l"], F.array_repeat(
        F.lit("0"), F.greatest(F.lit(0), 8 - F.size(h["l"]) - F.size(h["r"]))), h["r"]))
    return F.when(ip.contains(":"), F.array_join(F.transform(whole, lambda x: F.regexp_replace(x, "^0+(?=.)", "")), ":")).otherwise(ip)


def parsed(mention: Column, names: Column | None = None) -> Column:
    """The mention as a struct: text, kind, its entities' (kind, norm), and whether it is a bare word. A mention has one
    entity, a name with a title one for each word. A bare word is a name if it is among ``names`` (see
    ``titled_names``); any other one has the kind ``word`` and no entities.
    """

    def of(kind: Column) -> Column:
        norm = (F.when(kind == "email", F.lower(mention)).when(kind == "secret", _secret_value(mention))
                .when(kind.isin("card", "ssn", "phone", "iban"), F.regexp_replace(mention, r"[^0-9A-Za-z]", ""))
                .when(kind == "ip", _canonical_ip(mention)).otherwise(mention))
        one = F.array(F.struct(kind.alias("kind"), norm.alias("norm")))
        several = _let(F.struct(_name_words(mention).alias("words"), F.concat(F.lit("given_"), _title_gender(mention)).alias("given")),
                       lambda n: F.transform(n["words"], lambda w, i: F.struct(
                           F.when(i == F.size(n["words"]) - 1, F.lit("family")).otherwise(n["given"]).alias("kind"),
                           F.lower(w).alias("norm"))))
        return F.struct(mention.alias("text"), kind.alias("kind"), F.when(kind == "name", several).otherwise(one).alias("parts"),
                        F.lit(False).alias("bare"))

    whole = _let(kind_of(mention), of)
    if names is None:
        return whole
    bare = _let(_find(names, "form", mention), lambda known: F.struct(
        mention.alias("text"), F.when(known.isNull(), F.lit("word")).otherwise(F.lit("name")).alias("kind"),
        F.when(known.isNull(), F.array().cast("array<struct<kind:string,norm:string>>")).otherwise(
            F.array(F.struct(known["kind"].alias("kind"), known["norm"].alias("norm")))).alias("parts"), F.lit(True).alias("bare")))
    return F.when(mention.rlike(f"^{CAPITALISED}$") & ~mention.rlike(f"^(?:{SECRET})$"), bare).otherwise(whole)


def _name_words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, f"^{TITLE}", ""), " ")


def titled_names(text: Column) -> Column:
    """The words of the names that a text has with a title: structs of form (as written, capitalised and in upper
    case), kind and norm, sorted. A word of several kinds is found by its first."""
    none = F.array().cast("array<string>")
    found = F.when(_has_title(text), F.regexp_extract_all(text, F.lit(NAME), F.lit(0))).otherwise(none)

    def forms(word: Column, part: Column) -> Column:
        plain = F.regexp_replace(word, "[-'’]+$", "")
        return F.transform(F.array(plain, F.upper(plain), F.initcap(plain)), lambda f: F.struct(
            f.alias("form"), part["kind"].alias("kind"), part["norm"].alias("norm")))

    return F.sort_array(F.flatten(F.flatten(F.transform(found, lambda m: F.zip_with(_name_words(m), parsed(m)["parts"], forms)))))


def pattern_for(names: Column) -> Column:
    """ENTITY, and capitalised words too if the text has titled names."""
    return F.when(F.size(names) > 0, F.lit(ENTITY_OR_WORD)).otherwise(F.lit(ENTITY))


def _name_word(kind: Column, norm: Column, attempt: Column, stream: Column) -> Column:
    """A made-up word in the script of ``norm``: syllables and an ending by gender; longer after failed attempts."""

    def made(s: Script) -> Column:
        syllables = F.transform(F.sequence(F.lit(1), F.lit(3) + F.floor(attempt / 4).cast("int")), lambda i: F.concat(
            _pick(s.consonants, _byte(stream, i * 2)), _pick(s.vowels, _byte(stream, i * 2 + 1))))
        end = F.when(kind == "given_f", F.lit(s.female_end)).when(kind == "given_m", F.lit(s.male_end)).otherwise(F.lit(""))
        return F.concat(F.array_join(syllables, ""), end)

    word = made(LATIN_SCRIPT)
    for script in SCRIPTS:
        word = F.when(norm.rlike(script.pattern), made(script)).otherwise(word)
    return word


def surrogate_of(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """Normal form of an entity's surrogate at the given attempt."""
    stream = _stream(key, kind, norm, attempt, F.length(norm) + 16 + attempt)
    return _let(F.struct(kind.alias("kind"), norm.alias("norm"), attempt.alias("attempt"), stream.alias("stream")),
                lambda e: _drawn(e["kind"], e["norm"], e["attempt"], e["stream"], key))


def _drawn(kind: Column, norm: Column, attempt: Column, stream: Column, key: str) -> Column:
    """The draw. Later attempts are longer, so that there is room for any number of entities."""
    at = lambda i: _byte(stream, F.lit(i))

    def more(alphabet: str, count: Column) -> Column:
        places = F.sequence(F.lit(0), count.cast("int"))  # with the place 0, which gives nothing
        return F.array_join(F.transform(places, lambda i: F.when(i > 0, _pick(alphabet, _byte(
            stream, F.length(norm) + 8 + i))).otherwise(F.lit(""))), "")

    quick, slow = F.floor(attempt / 2), F.greatest(F.lit(0), F.floor((attempt - 14) / 2))
    spare = more(DIGITS, slow)  # for what has a fixed length and much room
    ip = F.concat_ws(".", (at(1) % 223 + 1).cast("string"), *[at(i).cast("string") for i in (2, 3, 4)])
    ip = F.when((slow > 0) | norm.contains(":"), F.concat(F.lit("2001:db8:"), F.regexp_replace(
        F.regexp_replace(F.substring(stream, 1, 24), "(.{4})(?=.)", "$1:"), "(^|:)0+(?=[^:])", "$1"))).otherwise(ip)
    plain = _same_class(norm, stream, F.lit(False))
    # A phone keeps what stands before its last ten digits (the country code) and a leading 0; an area does not
    # begin with 0 or 1.
    country = F.greatest(F.length(norm) - 10, norm.startswith("0").cast("int"))
    phone = F.concat(F.substring(norm, F.lit(1), country), _pick("23456789", at(1)),
                     F.substring(plain, country + 2, F.length(norm)),
                     more(DIGITS, F.when(F.length(norm) < 10, quick).otherwise(slow)))
    # A card keeps its first digit and whether its check digit is right.
    front = F.concat(F.substring(norm, 1, 1), F.substring(plain, F.lit(2), F.length(norm) - 2), spare)

    def checked(digits: Column) -> Column:
        right = (10 - _luhn(F.concat(digits, F.lit("0"))) % 10) % 10
        return F.concat(digits, _let(right, lambda r: F.when(_luhn(norm) % 10 == 0, r).otherwise(
            (r + 1 + at(1) % 9) % 10)).cast("string"))

    # So does an IBAN its country and whether its two check digits are right.
    country = F.substring(norm, 1, 2)
    valid = _mod97(F.concat(F.substring(norm, F.lit(5), F.length(norm)), F.substring(norm, 1, 4))) == 1

    def with_check(body: Column) -> Column:
        right = 98 - _mod97(F.concat(body, country, F.lit("00")))
        digits = F.when(valid, right).otherwise(2 + (right - 2 + 1 + at(1) % 95) % 97)
        return F.concat(country, F.lpad(digits.cast("string"), 2, "0"), body)

    iban = _let(F.concat(F.substring(plain, F.lit(5), F.length(norm)), spare), with_check)
    prefix = F.regexp_extract(norm, r"^(?:AKIA|(?:sk|ghp|gho|xoxb|xoxp)[-_])", 0)
    secret = _let(prefix, lambda p: _let(F.substring(norm, F.length(p) + 1, F.length(norm)), lambda rest: F.concat(
        p, more(DIGITS, quick), _same_class(rest, stream, rest.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")))))
    # The domain's last two labels become a reserved name; the labels before them keep their form.
    reserved = F.concat(F.lit("example."), F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")), at(2) % 3 + 1))

    def host(domain: Column) -> Column:
        leading = F.regexp_extract(domain, r"^(.*?)\.?[^.]*\.[^.]*$", 1)
        return _let(leading, lambda front: F.when(F.length(front) > 0, F.concat(
            _let(_stream(key, F.lit("domain"), domain, F.lit(0), F.length(domain)),
                 lambda s: _same_class(front, s, F.lit(False))), F.lit("."), reserved)).otherwise(reserved))

    email = F.concat(_same_class(F.substring_index(norm, "@", 1), stream, F.lit(False)), more(LOWER, quick), F.lit("@"),
                     _let(F.substring_index(norm, "@", -1), host))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone)
            .when(kind == "card", _let(front, checked)).when(kind == "ssn", F.concat(plain, spare)).when(kind == "iban", iban)
            .when(kind == "secret", secret).otherwise(_name_word(kind, norm, attempt, stream)))


def _cased(word: Column, like: Column) -> Column:
    """``word`` in upper case if ``like`` is, else capitalised if ``like`` is."""
    first = F.substring(like, 1, 1)
    return (F.when((F.length(like) > 1) & (like == F.upper(like)) & (like != F.lower(like)), F.upper(word))
            .when(first != F.lower(first), F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word))))
            .otherwise(word))


def replacement(mention: Column, attempts: Column, key: str) -> Column:
    """The text to stand for a parsed mention. ``attempts``: structs, sorted, of name ("kind:norm"), the kind to draw for
    and the attempt, where not its own and 0."""
    text, kind = mention["text"], mention["kind"]

    def drawn(part: Column) -> Column:
        return _let(_find(attempts, "name", F.concat_ws(":", part["kind"], part["norm"])), lambda a: surrogate_of(
            F.coalesce(a["as_kind"], part["kind"]), part["norm"], F.coalesce(a["attempt"], F.lit(0)), key))

    def placed(first: Column) -> Column:
        # Letters and digits of the mention take the surrogate's in turn; separators stay. A longer surrogate's rest follows.
        bare = lambda t: F.length(F.regexp_replace(t, "[^0-9A-Za-z]", ""))
        return F.concat(_each(text, lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substring(first, bare(
            F.substring(text, F.lit(1), i.cast("int"))), F.lit(1))).otherwise(c)),
            F.substring(first, bare(text) + 1, F.length(first)))

    title = F.regexp_extract(text, f"^{TITLE}", 0)
    name = _let(title, lambda t: F.concat(t, F.array_join(F.zip_with(
        F.split(F.substring(text, F.length(t) + 1, F.length(text)), " "), F.transform(mention["parts"], drawn),
        lambda w, d: _cased(d, w)), " ")))
    word = F.regexp_extract(text, f"^{SECRET_WORD}", 0)
    single = _let(drawn(mention["parts"][0]), lambda first: (
        F.when(kind == "email", F.when(text == F.upper(text), F.upper(first)).otherwise(first))
        .when(kind == "ip", F.when(text.rlike("[A-F]"), F.upper(first)).otherwise(first)).when(kind == "secret", F.concat(word, first)).otherwise(placed(first))))
    return F.when(kind == "word", text).when(kind == "name", name).otherwise(single)


def _has_title(text: Column) -> Column:
    titled = F.lit(False)
    for title in MALE + FEMALE + NEUTRAL:
        titled = titled | text.contains(title)
    return titled


def mentions_of(text: Column, pattern: Column) -> Column:
    """All entity mentions of a text, in order; texts without a digit, @, :: or title are not searched."""
    candidate = text.rlike("[0-9@]|::") | _has_title(text)
    none = F.array().cast("array<string>")
    return F.when(candidate, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none)


def attempts(entities: DataFrame, key: str, max_rounds: int = 60) -> DataFrame:
    """kind, norm, attempt of the entities (distinct kind, norm) whose first surrogates are not free.

    In each round the open entities draw. A draw fails if it is an original value of its kind, is in use,
    or the same as that of a smaller open entity; the entity then draws again in the next round.
    """
    originals = entities.select("kind", F.col("norm").alias("drawn"))
    open_, used, late = entities, None, None
    for attempt in range(max_rounds):
        draws = open_.withColumn("drawn", surrogate_of(F.col("kind"), F.col("norm"), F.lit(attempt), key))
        draws = materialize(draws, "pii-draws")
        winners = draws.groupBy("kind", "drawn").agg(F.min("norm").alias("norm")).join(
            originals, ["kind", "drawn"], "left_anti")
        if used is not None:
            winners = winners.join(used, ["kind", "drawn"], "left_anti")
        winners = materialize(winners, "pii-winners")
        if attempt:
            found = winners.select("kind", "norm", F.lit(attempt).alias("attempt"))
            late = found if late is None else late.unionByName(found)
        open_ = materialize(open_.join(winners.select("kind", "norm"), ["kind", "norm"], "left_anti"), "pii-open")
        if open_.isEmpty():
            return late if late is not None else found_none(entities)
        taken = winners.select("kind", "drawn")
        used = taken if used is None else used.unionByName(taken)
    raise RuntimeError(f"no free surrogates after {max_rounds} rounds")


def found_none(entities: DataFrame) -> DataFrame:
    return entities.select("kind", "norm", F.lit(0).alias("attempt")).limit(0)


def pseudonymised(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with surrogates in the text, and n_entities (mentions replaced).

    Equal entities have equal surrogates in all rows, distinct ones distinct surrogates, and no surrogate
    is an original value of its kind. Null texts stay null with 0 entities, texts without entities stay as
    they are. Other columns stay, but for one named n_entities, which is replaced. An empty table stays
    empty.
    """
    names = [c for c in docs.columns if c != "n_entities"]
    text = F.col(text_column)

    def searched(rows: DataFrame) -> DataFrame:
        """With __names, __pattern and __mentions, each computed once for a row."""
        return (rows.withColumn("__names", titled_names(F.col("__text")))
                .withColumn("__pattern", pattern_for(F.col("__names")))
                .withColumn("__mentions", F.transform(mentions_of(F.col("__text"), F.col("__pattern")),
                                                      lambda m: parsed(m, F.col("__names")))))

    def parts_of(rows: DataFrame, *keys: str) -> DataFrame:
        """Distinct kind and norm of the entities, by ``keys``.

        ``explode_outer``, as Spark puts a filter on the array below a plain ``explode``; the filter would hold all of
        ``searched`` as one expression, with the names found again in every step of a look-up.
        """
        found = rows.select(*keys, F.explode_outer("__mentions").alias("mention")).select(
            *keys, F.explode_outer("mention.parts").alias("part"))
        return found.filter("part IS NOT NULL").select(*keys, "part.kind", "part.norm").distinct()

    entities = materialize(parts_of(searched(docs.select(text.alias("__text")))), "pii-entities")
    # A given name with a neutral title is the same as with Mr or Mrs, if it is known with one of them only.
    known = (entities.filter(F.col("kind").isin("given_m", "given_f")).groupBy("norm")
             .agg(F.min("kind").alias("as_kind"), F.max("kind").alias("other")).filter("as_kind = other").select("norm", "as_kind"))
    resolved = materialize(entities.join(known, "norm", "left").select("kind", "norm", F.when(
        F.col("kind") == "given_x", F.coalesce("as_kind", "kind")).otherwise(F.col("kind")).alias("as_kind")), "pii-resolved")
    own = resolved.filter("kind = as_kind").select("kind", "norm")
    late = resolved.join(attempts(own, key).select(F.col("kind").alias("as_kind"), "norm", "attempt"),
                         ["as_kind", "norm"], "left").filter("attempt IS NOT NULL OR kind <> as_kind")
    late = materialize(late.select("kind", "norm", "as_kind", F.coalesce("attempt", F.lit(0)).alias("attempt")), "pii-late")
    empty = F.array().cast("array<struct<name:string,as_kind:string,attempt:int>>")
    rows = searched(docs.select(F.struct(*names).alias("__doc"), text.alias("__text"), F.col(id_column).alias("__id"),
                                F.xxhash64(text).alias("__hash")))
    if late.isEmpty():
        rows = rows.withColumn("__attempts", empty)
    else:
        # Per document with such an entity: its later attempts and resolved kinds.
        mentioned = (parts_of(rows, "__id", "__hash").join(late, ["kind", "norm"])
                     .groupBy("__id", "__hash").agg(F.sort_array(F.collect_list(F.struct(
                         F.concat_ws(":", "kind", "norm").alias("name"), "as_kind", "attempt"))).alias("__late")))
        mentioned = materialize(mentioned.select(F.col("__id").alias("__lid"), F.col("__hash").alias("__lhash"), "__late"),
                                "pii-mentioned")
        rows = rows.join(mentioned, F.col("__id").eqNullSafe(F.col("__lid")) & (F.col("__hash") == F.col("__lhash")),
                         "left").withColumn("__attempts", F.coalesce("__late", empty))
    # A column of its own, as ``counted`` looks into it once for each mention.
    rows = rows.withColumn("__gaps", F.when(F.size("__mentions") > 0, F.split(F.col("__text"), F.col("__pattern"), -1)))
    gaps = F.col("__gaps")
    stands = F.transform("__mentions", lambda m: replacement(m, F.col("__attempts"), key))
    whole = F.concat(F.array_join(F.zip_with(F.slice(gaps, F.lit(1), F.size("__mentions")), stands,
                                             lambda g, s: F.concat(g, s)), ""), F.element_at(gaps, -1))
    new = F.when(F.size("__mentions") > 0, whole).otherwise(F.col("__text"))
    kept = [new.alias(c) if c == text_column else F.col("__doc")[c].alias(c) for c in names]
    # Bare words of a name that follow each other are one mention.
    counted = F.transform("__mentions", lambda m, i: (m["kind"] != "word") & ~F.when(i > 0, m["bare"] & _let(
        F.get("__mentions", i - 1), lambda b: b["bare"] & (b["kind"] != "word")) & (F.get(gaps, i) == " ")).otherwise(F.lit(False)))
    return rows.select(*kept, F.coalesce(F.size(F.filter(counted, lambda x: x)), F.lit(0)).cast("long").alias("n_entities"))
