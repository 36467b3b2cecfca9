"""Surrogates for personal data and secrets, in DataFrame functions only.

Mentions are found by patterns. Each is made of units (an e-mail address and its domain, a number, the words of a name), and every unit gets a
surrogate: characters or syllables drawn by a keyed hash of the unit, of its kind and format. The same unit gets the same surrogate
everywhere, so coreference survives; a check over the distinct units of all rows makes sure that no two units of a kind share a surrogate and that no
surrogate is a real unit. Units that fail draw again, after three attempts from a space that
grows with each further one, so drawing ends however dense the real units are. Until then surrogates keep separators, letter case, length, the script and gender of names, the first digit
and check digit of cards, check digits of IBANs, octet lengths, key prefixes and top-level domains.

A surrogate is a function of unit, key and attempt, so texts are rewritten inside their rows; only rows with units whose first attempt failed are joined
with their attempts.

Defined results: NULL texts stay NULL; rows without a mention keep their text; repeated rows get equal results; overlapping mentions are taken from the
left, longest kind first in the order of ``PATTERNS``; an empty table gives no rows; other columns are kept, result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import materialize

# First names and titles by gender, for names without and with a title.
MALE = ("James John Robert Michael William David Thomas Daniel Peter Paul Hans Klaus Jürgen Pierre Jean Jacques Carlos José Luis Miguel "
        "Иван Пётр Сергей Алексей Дмитрий Николай").split()
FEMALE = ("Mary Patricia Jennifer Linda Elizabeth Susan Sarah Karen Anna Emma Ursula Monika Sabine Marie Claire Sophie María Carmen Lucía Elena "
          "Мария Ольга Наталья Татьяна Ирина Светлана").split()
MALE_TITLES = "Mr Herr Monsieur Señor Господин".split()
FEMALE_TITLES = "Mrs Ms Miss Frau Madame Señora Госпожа".split()

# Syllables and endings that surrogate names are made of, by script and gender.
SYLLABLES = {
    "latin": "bel cor dal fen gar hal jor kel lan mor nel per quin ral sal tor ul ven wil yor zan bri cla dre".split(),
    "cyrillic": "бел вер гор дан жар зор кол лан мар нов пол рад сол тим ур фед хар цел чер шав юр яр бор глеб".split(),
}
ENDINGS = {
    ("latin", "male"): "o us er ard".split(), ("latin", "female"): "a ia ine elle".split(), ("latin", "none"): "ey en is y".split(),
    ("latin", "surname"): "son ley man ton well berg ford stein".split(),
    ("cyrillic", "male"): "ан ий ей ор".split(), ("cyrillic", "female"): "а ия ина ья".split(), ("cyrillic", "none"): "и е о у".split(),
    ("cyrillic", "surname"): "ов ев ин ский енко ко ук ман".split(),
}

_WORD = r"\p{Lu}[\p{L}'’]+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Kinds in the order in which they are tried at a place. Secrets have no greatest length: what is found is replaced to its end.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "key": r"(?<![0-9A-Za-z])(?:AKIA|ASIA)[0-9A-Z]{16,}+(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:sk|pk|ghp|gho|xox[bp])[-_][0-9A-Za-z_-]{16,}+",
    # Of more than 128 digits, only letters are a run of text: a random secret has no 0-9 with a chance of (3/8)^129.
    "hex": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![0-9A-Za-z])"
           r"|(?<![0-9A-Za-z])(?:(?=[a-f]*+[0-9])[0-9a-f]{129,}+|(?=[A-F]*+[0-9])[0-9A-F]{129,}+)(?![0-9A-Za-z])",
    "secret": r"(?i:(?<=(?:password|passwd|secret|token|api_key|apikey) {0,3}[=:] {0,3}[\"']?))(?![\"'])[^\s\"',;]{6,}+",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,5}){2,5}(?![0-9])|(?<![0-9A-Za-z(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?![0-9])"
             r"|(?<![0-9A-Za-z.-])\d{3}([.-])\d{3}\1\d{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])\d(?:[ -]?\d){12,18}(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? {_WORD}(?: {_WORD}){{0,2}}"
            rf"|(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE)})(?: {_WORD}){{1,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values()).replace(r"([.-])\d{3}\1", r"[.-]\d{3}[.-]")
# What every mention has: a cheap test before the patterns. Keys and hexadecimal secrets need not hold a digit 0-9.
_HINT = r"[0-9@]|(?<![0-9A-Za-z])(?:(?:AKIA|ASIA)[A-Z]{16}|(?:sk|pk|ghp|gho|xox[bp])[-_][A-Za-z_-]{16}|[a-f]{32}|[A-F]{32})|(?i:password|passwd|secret|token|api_?key) {0,3}[=:]|(?<!\p{L})(?:" + "|".join(MALE_TITLES + FEMALE_TITLES + MALE + FEMALE) + r")\.? \p{Lu}"

# What other letters and symbols are drawn from. Letters of further scripts are drawn as Latin ones.
ALPHABETS = {
    "IsLatin": "àáâãäåæçèéêëìíîïñòóôõöøùúûüýþ", "IsCyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "IsGreek": "αβγδεζηθικλμνξοπρστυφχψω",
    "IsArmenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփք", "IsGeorgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "IsHebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "IsArabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "IsDevanagari": "अआइईउऊएऐओऔकखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह",
    "IsThai": "กขคงจฉชซญดตถทธนบปผพภมยรลวศษสหอ", "IsHiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわん",
    "IsKatakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン",
    "IsHangul": "가나다라마바사아자차카타파하거너더러머버서어저처커터퍼허고노도로모보소오조초코토포호",
    "IsHan": "一二三四五六七八九十上下大小中人口手心日月水火木金土石田山川天地花草風雨雪雲東西南北春夏秋冬白黑青紅",
}
SYMBOLS = "!#$%&*?@^~+="
# Symbols that part a secret; they stay if it has letters or digits.
_PARTING = r"[-_.:/+=]"

UNITS = "array<struct<kind: string, norm: string>>"


def maybe(text: Column) -> Column:
    return F.coalesce(text.rlike(_HINT), F.lit(False))


def mentions_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def kind_of(mention: Column) -> Column:
    """The kind of a mention that the patterns have found."""
    out = F.when(mention.contains("@") & mention.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    for kind in ("key", "hex", "iban", "ip", "ssn", "phone"):
        out = out.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    out = out.when(mention.rlike(r"^\d[\d -]+$"), "card")
    return out.when(mention.rlike(rf"^(?:{PATTERNS['name']})$"), "name").otherwise("secret")


def _is_upper(word: Column) -> Column:
    return (F.upper(word) == word) & (F.length(word) > 1)


def _bare(word: Column) -> Column:
    return F.regexp_replace(word, r"\.$", "")


def _gender(words: Column) -> Column:
    first = _bare(F.get(words, F.lit(0)))
    return F.when(first.isin(*MALE, *MALE_TITLES), "male").when(first.isin(*FEMALE, *FEMALE_TITLES), "female").otherwise("none")


def _name_units(mention: Column) -> Column:
    """A unit per word of a name: titles as they are, first names with their gender, surnames."""
    words = F.split(mention, " ")
    last = F.size(words) - 1
    script = F.when(mention.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def unit(word: Column, at: Column) -> Column:
        title = _bare(word).isin(*MALE_TITLES, *FEMALE_TITLES)
        role = F.when(title, "title").when(at == last, F.concat(script, F.lit(":surname"))).otherwise(
            F.concat(script, F.lit(":"), _gender(words)))
        return F.struct(role.alias("kind"), F.when(title, word).otherwise(F.lower(word)).alias("norm"))

    return F.transform(words, unit)


def units_of(mention: Column, kind: Column) -> Column:
    """The units of a mention, in a normal form in which differently written mentions of the same thing are equal."""
    low = F.lower(mention)
    digits = F.regexp_replace(mention, "[^0-9A-Za-z]", "")
    one = lambda k, norm: F.struct(k.alias("kind"), norm.alias("norm"))
    email = F.array(one(F.lit("email"), low), one(F.lit("domain"), F.substring_index(low, "@", -1)))
    plain = F.array(one(kind, F.when(kind.isin("phone", "card", "ssn", "iban"), digits).otherwise(mention)))
    return F.when(kind == "email", email).when(kind == "name", _name_units(mention)).otherwise(plain).cast(UNITS)


def _chars(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(r"(?s)."), F.lit(0))


def _draw(digest: Column, at: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(digest, at), F.lit(n)).cast("int")


def _pick(letters: str, digest: Column, at: Column) -> Column:
    return F.substr(F.lit(letters), _draw(digest, at, len(letters)) + 1, F.lit(1))


def _wider(value: Column, attempt: Column, pad: Column) -> Column:
    """``value`` with room for another character in each attempt after the third, so that no space of surrogates is used up."""
    return F.concat(value, F.repeat(pad, F.greatest(attempt - 2, F.lit(0))))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, and not again for each character."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _redrawn(value: Column, digest: Column, keep: Column, hexadecimal: Column, symbols: Column | None = None) -> Column:
    """Digits for digits and letters for letters, after the first ``keep`` characters; letters for symbols where ``symbols`` is true."""
    given = F.struct(keep.alias("keep"), (F.lit(False) if symbols is None else symbols).alias("symbols"))

    def char(c: Column, at: Column, keep: Column, symbols: Column) -> Column:
        lower = F.when(hexadecimal, _pick("abcdef", digest, at)).otherwise(_pick("abcdefghijklmnopqrstuvwxyz", digest, at))
        out = (F.when(at < keep, c).when(c.rlike("[0-9]"), _pick("0123456789", digest, at)).when(c.rlike("[a-z]"), lower)
               .when(c.rlike("[A-Z]"), F.upper(lower)))
        return out.when(symbols, lower).otherwise(c)

    return _once(given, lambda g: F.array_join(F.transform(_chars(value), lambda c, at: char(c, at, g["keep"], g["symbols"])), ""))


def _secret(norm: Column, digest: Column, attempt: Column) -> Column:
    """Every character drawn again: digits, letters within their script and case, symbols from a set of symbols."""
    def char(c: Column, at: Column, parted: Column) -> Column:
        lower = _pick("abcdefghijklmnopqrstuvwxyz", digest, at)
        # Most characters are ASCII: the scripts are tried only for the others.
        other = F.when(c.rlike(r"\p{N}"), _pick("0123456789", digest, at))
        for script, letters in ALPHABETS.items():
            drawn = _pick(letters, digest, at)
            other = other.when(c.rlike(rf"(?=\p{{L}})\p{{{script}}}"), F.when(c.rlike(r"\p{Lu}"), F.upper(drawn)).otherwise(drawn))
        other = other.when(c.rlike(r"\p{L}"), lower).otherwise(_pick(SYMBOLS, digest, at))
        return (F.when(c.rlike("[0-9]"), _pick("0123456789", digest, at)).when(c.rlike("[a-z]"), lower).when(c.rlike("[A-Z]"), F.upper(lower))
                .when(parted & c.rlike(_PARTING), c).otherwise(other))

    value = _wider(norm, attempt, F.lit("a"))
    return _once(norm.rlike(r"[\p{L}\p{N}]"), lambda parted: F.array_join(F.transform(_chars(value), lambda c, at: char(c, at, parted)), ""))


def luhn_sum(digits: Column) -> Column:
    """Sum of a card number's digits with every second one from the right doubled."""
    def add(c: Column, at: Column) -> Column:
        d = c.cast("int")
        return F.when(at % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.reverse(_chars(digits)), add), F.lit(0), lambda acc, d: acc + d)


def _card(norm: Column, digest: Column, attempt: Column) -> Column:
    drawn = _redrawn(_wider(norm, attempt, F.lit("0")), digest, F.lit(1), F.lit(False))
    body = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    check = F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(luhn_sum(norm) % 10 == 0, F.concat(body, check)).otherwise(drawn)


def _ip(norm: Column, digest: Column, attempt: Column) -> Column:
    """Octets of the same lengths; after three attempts of any, and where even those are used up, numbers beyond 255."""
    def octet(o: Column, at: Column) -> Column:
        alike = F.when(F.length(o) == 1, 1 + _draw(digest, at, 9)).when(F.length(o) == 2, 10 + _draw(digest, at, 90)).otherwise(
            100 + _draw(digest, at, 155))
        beyond = 254 * F.pow(F.lit(2), F.greatest(attempt - 9, F.lit(0))).cast("long")
        return F.when(attempt < 3, alike).otherwise(1 + F.pmod(F.xxhash64(digest, at), beyond)).cast("string")

    return F.array_join(F.transform(F.split(norm, r"\."), octet), ".")


def _iban(norm: Column, digest: Column, attempt: Column) -> Column:
    drawn = _redrawn(_wider(norm, attempt, F.lit("0")), digest, F.lit(2), F.lit(False))
    body = F.substr(drawn, F.lit(5), F.length(drawn))
    country = F.substr(norm, F.lit(1), F.lit(2))
    value = lambda c: F.when(c.rlike("[0-9]"), c).otherwise((F.ascii(c) - 55).cast("string"))
    number = F.array_join(F.transform(_chars(F.concat(body, country, F.lit("00"))), value), "")
    rest = F.aggregate(_chars(number), F.lit(0), lambda acc, c: (acc * 10 + c.cast("int")) % 97)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), body)


def _syllable(words: list[str], digest: Column, at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), _draw(digest, at, len(words)) + 1)


def _stem(syllables: list[str], digest: Column, attempt: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), 2 + attempt), lambda at: _syllable(syllables, digest, at)), "")


def _name(kind: Column, digest: Column, attempt: Column) -> Column:
    """Two syllables, another one for each attempt, and an ending that fits script and gender."""
    out = F.lit(None).cast("string")
    for (script, role), endings in ENDINGS.items():
        stem = _stem(SYLLABLES[script], digest, attempt)
        out = F.when(kind == f"{script}:{role}", F.concat(stem, _syllable(endings, digest, F.lit(0)))).otherwise(out)
    return out


def digest_of(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string")), 256)


def surrogate(kind: Column, norm: Column, attempt: Column, digest: Column) -> Column:
    """The surrogate of a unit, drawn by its keyed ``digest``.

    That of an e-mail address holds the real domain, which has a surrogate of its own.
    """
    no, letter, digit = F.lit(False), F.lit("a"), F.lit("0")
    own = F.substring_index(norm, "@", 1)
    local = _redrawn(_wider(own, attempt, letter), digest, F.lit(0), no, ~own.rlike("[0-9A-Za-z]"))
    host = F.regexp_replace(norm, r"\.[^.]*$", "")
    domain = F.concat(_redrawn(_wider(host, attempt, letter), digest, F.lit(0), no), F.substr(norm, F.length(host) + 1, F.length(norm)))
    prefix = F.when(norm.rlike("^A[KS]IA"), 4).otherwise(F.length(F.regexp_extract(norm, r"^[a-z]+[-_]", 0)))
    upper = F.when(norm.rlike("^A[KS]IA"), "A").otherwise(letter)
    return (
        F.when(kind == "email", F.concat(local, F.lit("@"), F.substring_index(norm, "@", -1)))
        .when(kind == "domain", domain)
        .when(kind == "key", _redrawn(_wider(norm, attempt, upper), digest, prefix, no, ~norm.rlike("^[a-z]+[-_].*[0-9A-Za-z]|^A")))
        .when(kind == "hex", _redrawn(_wider(norm, attempt, F.when(norm.rlike("[A-F]"), "A").otherwise(letter)), digest, F.lit(0), F.lit(True)))
        .when(kind == "secret", _secret(norm, digest, attempt))
        .when(kind == "ip", _ip(norm, digest, attempt)).when(kind == "iban", _iban(norm, digest, attempt)).when(kind == "card", _card(norm, digest, attempt))
        .when(kind == "phone", _redrawn(_wider(norm, attempt, digit), digest, F.lit(1), no))
        .when(kind == "ssn", _redrawn(_wider(norm, attempt, digit), digest, F.lit(0), no))
        .when(kind == "title", norm).otherwise(_name(kind, digest, attempt))
    )


def _laid_over(mention: Column, value: Column) -> Column:
    """The letters and digits of ``value`` in the place of those of ``mention``, with its separators and case; linear in the length."""
    new = F.regexp_extract_all(value, F.lit(r"[\p{L}\p{N}]"), F.lit(0))
    # Separators and the letter or digit after them; what follows the last one is the tail.
    parts = F.regexp_extract_all(mention, F.lit(r"[^\p{L}\p{N}]*+[\p{L}\p{N}]"), F.lit(0))

    def part(p: Column, drawn: Column) -> Column:
        cased = F.when(p.rlike(r"\p{Lu}$"), F.upper(drawn)).otherwise(drawn)
        return F.concat(F.substr(p, F.lit(1), F.length(p) - 1), F.coalesce(cased, F.lit("")))

    tail = F.substr(mention, F.length(F.array_join(parts, "")) + 1)
    return F.concat(F.array_join(F.zip_with(parts, new, lambda p, drawn: F.when(p.isNull(), drawn).otherwise(part(p, drawn))), ""), tail)


def _cased(mention: Column, value: Column) -> Column:
    """``value``, at least as long as ``mention``, with the capitals of ``mention``."""
    return F.array_join(F.zip_with(_chars(mention), _chars(value), lambda c, v: F.when(c.rlike("[A-Z]"), F.upper(v)).otherwise(v)), "")


def replacement(mention: Column, units: Column, made: Column) -> Column:
    """What stands for a mention, given its units and their surrogates."""
    first = F.get(units, F.lit(0))["kind"]
    host = lambda domain: F.regexp_replace(F.substring_index(domain, "@", -1), r"\.[^.]*$", "")
    email = F.concat(_cased(F.substring_index(mention, "@", 1), F.substring_index(F.get(made, F.lit(0)), "@", 1)), F.lit("@"),
                     _cased(host(mention), host(F.get(made, F.lit(1)))), F.lit("."), F.substring_index(mention, ".", -1))
    words = F.split(mention, " ")
    cased = F.zip_with(words, made, lambda w, s: F.when(_is_upper(w), F.upper(s)).when(w.rlike(r"^\p{Lu}"), F.initcap(s)).otherwise(s))
    titles = F.zip_with(words, units, lambda w, u: F.when(u["kind"] == "title", w))
    name = F.array_join(F.zip_with(cased, titles, lambda s, w: F.coalesce(w, s)), " ")
    whole = first.isin("key", "hex", "secret", "ip")
    return F.when(first.contains(":") | (first == "title"), name).when(first == "email", email).when(whole, F.get(made, F.lit(0))).otherwise(
        _laid_over(mention, F.get(made, F.lit(0))))


def with_units(df: DataFrame, mentions: Column, out: str) -> DataFrame:
    """Add ``out``: array of (mention, units). Steps are columns of their own, so each is evaluated once."""
    kinds = F.transform(mentions, lambda m: F.struct(m.alias("mention"), kind_of(m).alias("kind")))
    return df.withColumn("__llm_kinds", kinds).withColumn(out, F.transform(
        "__llm_kinds", lambda x: F.struct(x["mention"].alias("mention"), units_of(x["mention"], x["kind"]).alias("units")))).drop("__llm_kinds")


def with_replacements(df: DataFrame, units: str, attempt_of: Callable[[Column, Column], Column], key: str, out: str) -> DataFrame:
    """Add ``out``: what stands for each mention of ``units``; ``attempt_of`` gives the attempt of a unit."""
    def drawn(u: Column) -> Column:
        attempt = attempt_of(u["kind"], u["norm"])
        return F.struct(u["kind"].alias("kind"), u["norm"].alias("norm"), attempt.alias("attempt"),
                        digest_of(u["kind"], u["norm"], attempt, key).alias("digest"))

    def named(u: Column) -> Column:
        return surrogate(u["kind"], u["norm"], u["attempt"], u["digest"])

    each = lambda column, part: F.transform(column, lambda x: F.struct(x["mention"].alias("mention"), *part(x)))
    df = df.withColumn("__llm_drawn", each(units, lambda x: [F.transform(x["units"], drawn).alias("units")]))
    df = df.withColumn("__llm_made", each("__llm_drawn", lambda x: [x["units"].alias("units"), F.transform(x["units"], named).alias("made")]))
    return df.withColumn(out, F.transform("__llm_made", lambda x: replacement(x["mention"], x["units"], x["made"]))).drop("__llm_drawn", "__llm_made")


def attempts(units: DataFrame, key: str) -> DataFrame:
    """(kind, norm, attempt) of distinct units such that surrogates of a kind differ and none is a real unit.

    Each round, of the units that share a surrogate the first stays, by attempt and name; the others draw again. The space of surrogates
    grows with the attempt (longer values, other octet lengths, more syllables), so the rounds end.
    """
    def drawn(df: DataFrame) -> DataFrame:
        df = df.withColumn("digest", digest_of(F.col("kind"), F.col("norm"), F.col("attempt"), key))
        return df.withColumn("new", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), F.col("digest"))).drop("digest")

    real = units.select(F.col("kind").alias("_kind"), F.col("norm").alias("_norm"))
    table = materialize(drawn(units.withColumn("attempt", F.lit(0))), "pii-units")
    while True:
        keeper = table.groupBy("kind", "new").agg(F.min(F.struct("attempt", "norm")).alias("_keeper")).withColumnsRenamed(
            {"kind": "_k", "new": "_n"})
        marked = table.join(keeper, (F.col("kind") == F.col("_k")) & (F.col("new") == F.col("_n"))).join(
            real, (F.col("kind") == F.col("_kind")) & (F.col("new") == F.col("_norm")), "left")
        again = (F.col("_keeper.norm") != F.col("norm")) | F.col("_norm").isNotNull()
        marked = materialize(marked.select("kind", "norm", "attempt", "new", again.alias("again")), "pii-units")
        if not marked.where("again").limit(1).count():
            return marked.drop("again", "new")
        moved = drawn(marked.where("again").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")))
        table = materialize(marked.where("NOT again").drop("again").unionByName(moved), "pii-units")


def pseudonymize(df: DataFrame, key: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Replace all mentions in ``text``; adds ``n_entities``, the number of mentions replaced."""
    at = F.struct(F.col(row_id).alias("id"), F.xxhash64(text).alias("hash"))
    hinted = df.where(maybe(F.col(text))).select(
        at.alias("__llm_at"), F.explode(F.array_distinct(mentions_of(F.col(text)))).alias("mention"))
    found = hinted.withColumn("kind", kind_of(F.col("mention"))).select(
        "__llm_at", F.explode(units_of(F.col("mention"), F.col("kind"))).alias("u"))
    found = materialize(found.select("__llm_at", "u.*").where("kind <> 'title'"), "pii-mentions")
    tried = attempts(found.select("kind", "norm").distinct(), key).where("attempt > 0").withColumnsRenamed({"kind": "_kind", "norm": "_norm"})
    name = lambda kind, norm: F.concat_ws("\x1f", kind, norm)
    # Rows with units that had to draw again: their attempts. Mostly empty, and then small enough for Spark to broadcast.
    special = found.join(tried, (F.col("kind") == F.col("_kind")) & (F.col("norm") == F.col("_norm"))).groupBy("__llm_at").agg(
        F.map_from_entries(F.collect_set(F.struct(name(F.col("kind"), F.col("norm")), "attempt"))).alias("__llm_tried"))
    special = materialize(special.withColumnRenamed("__llm_at", "__llm_special"), "pii-special")

    rows = df.withColumn("__llm_at", at).join(special, F.col("__llm_at") == F.col("__llm_special"), "left")
    mentions = F.when(maybe(F.col(text)), mentions_of(F.col(text))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("__llm_found", mentions)
    attempt_of = lambda kind, norm: F.coalesce(F.try_element_at(F.col("__llm_tried"), name(kind, norm)), F.lit(0))
    rows = with_units(rows, F.col("__llm_found"), "__llm_units")
    rows = with_replacements(rows, "__llm_units", attempt_of, key, "__llm_new")
    between = F.split(F.col(text), ANY, -1)
    whole = F.array_join(F.zip_with(between, F.col("__llm_new"), lambda b, s: F.concat(b, F.coalesce(s, F.lit("")))), "")
    others = [c for c in df.columns if c not in (text, "n_entities")]
    return rows.select(*others, F.when(F.size("__llm_found") > 0, whole).otherwise(F.col(text)).alias(text),
                       F.size("__llm_found").cast("long").alias("n_entities"))
