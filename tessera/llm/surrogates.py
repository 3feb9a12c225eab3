"""PII surrogates: detected entities get keyed, type-consistent replacements, in DataFrame expressions alone.

Entities are e-mail addresses, phone, card, account (IBAN) and social security numbers, IPv4 and IPv6 addresses,
secrets, access keys, dates of birth and passport numbers after a word that says so, street addresses, and names of
persons: after a title, before a Chinese one, or a known given name and what follows. All but later mentions of a name
are found by one pattern. A surrogate is a function of the key and the entity, so equal entities get equal surrogates
wherever they stand (coreference) and no lookup is needed. Digits go through a Feistel permutation of strings of their
length, which keeps lengths, punctuation, country codes, card checksums and IBAN check digits and maps different numbers to
different ones; dotted addresses and dates likewise; e-mail names keep their shape, and equal domains get equal
domains. Names are replaced word by word, given and family names apart, with title, gender, script and capitals kept, so
'Mr Smith', 'Dr. John Smith' and, in a text that names him in full, a bare 'Smith' agree. Then collisions are checked over
the distinct entities and name words of all documents: where two would get the same surrogate, or one would get
another's original, all but the first get others from a later round, until none collides; should MOST_ROUNDS not be
enough (numbers that fill their whole space), the operator raises and replaces nothing.

Defined results: a null text stays null, an empty one empty; a text without entities is returned as it is; repeated
rows are treated alike; the columns and all other values of the input are kept, whatever their names; doc_id need not
be unique or set. Not found are names without a title whose given name is not in GIVEN, and family names of two letters
where they stand alone.
"""

from __future__ import annotations

import json
import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import settled

#: Titles by the gender that they tell.
MALE = "Mr Mister Herr Señor Sr Don Monsieur Signor Господин".split()
FEMALE = "Mrs Ms Miss Frau Señora Sra Señorita Srta Doña Madame Mme Mademoiselle Mlle Signora Госпожа".split()
NEUTRAL = "Dr Doctor Dra Prof Professor Profesor Profesora Professeur Доктор Профессор".split()
AFTER = {"先生": "m", "女士": "f", "小姐": "f", "太太": "f"}
#: Given names that tell a person without a title, and their gender.
GIVEN = {
    "m": "John James Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Steven Andrew Kenneth Kevin Brian George Edward Ronald Timothy Jason Jeffrey Gary Nicholas Eric Stephen Peter Paul Juan José Carlos Luis Miguel Javier Alejandro Pedro Diego Fernando Jean Pierre Jacques François Philippe Antoine Hans Jürgen Klaus Wolfgang Stefan Andreas Matthias Heinrich Иван Дмитрий Сергей Алексей Николай".split(),
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Ashley Emily Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Laura Helen Anna Ana María Carmen Lucía Isabel Elena Sofía Pilar Marie Sophie Camille Juliette Nathalie Isabelle Céline Ursula Monika Sabine Petra Heike Katharina Анна Мария Елена Ольга Наталья".split(),
}
#: Syllables from which surrogate names are built, by script and gender: starts, middles, endings.
STARTS = {"latin": "Al Be Cor Da El Fen Gar Hol Is Jo Kel Lin Mar Nor Os Per Ro San Tor Wil".split(), "cyrillic": "Ал Бе Вас Гри Де Ели За Ива Кон Лео Ма Ник Оле Пе Ром Се Ти Фе Юр Яр".split(), "greek": "Αλ Βα Γερ Δη Ελ Ζα Θε Ιω Κων Λε Μα Νι Ορ Πα Ρο Στα Τι Φι Χα Ψα".split()}
MIDDLES = {"latin": "ba de li mo na ri sa te vi lo ran den mer ton bel kin sor dal wen har".split(), "cyrillic": "ба де ли мо на ри са те ви ло ран ден мер тон бел кин сор дал вен гор".split(), "greek": "βα δε λι μο να ρι σα τε φι λο ραν δεν μερ τον βελ κιν σορ δαλ βεν γορ".split()}
ENDS = {("latin", "m"): "den las ric ton vin mon".split(), ("latin", "f"): "ella ina ora essa ida anne".split(), ("latin", "n"): "man berg ford son well ley".split(), ("cyrillic", "m"): "дан лий слав мир тин рей".split(), ("cyrillic", "f"): "елла ина ора ида анна ея".split(), ("cyrillic", "n"): "ко чук дзе ян ич ук".split(), ("greek", "m"): "δας νης λος τος ρης μος".split(), ("greek", "f"): "έλλα ίνα όρα ίδα άννα εία".split(), ("greek", "n"): "ίδης άκης πουλος ίου ούδης έας".split()}
#: Chinese family names, each of which is one character, and characters of given names by gender.
SURNAMES = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何林罗高郑梁谢宋唐许韩冯邓曹"
HAN = {"m": "伟强磊军洋勇杰涛明超刚平辉鹏华飞鑫波斌宇浩凯健俊帆", "f": "芳娜敏静丽艳娟霞秀英玲桂兰雪梅琳慧婷颖洁红燕萍莉倩"}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ROUNDS = 4
#: Rounds of new surrogates for what collides, and colliding entities that are listed in the plan at most.
MOST_ROUNDS, MOST_LISTED = 32, 1000

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_HEX = "[0-9A-Fa-f]{1,4}"
_TITLES = "|".join(MALE + FEMALE + NEUTRAL)
_GIVEN = "|".join(GIVEN["m"] + GIVEN["f"])
_DATE = r"(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4})"
_ROAD = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Square"
_FIRST = rf"(?<!\p{{L}})(?:{_TITLES})\.? (?:\p{{Lu}}\.? )?{_NAME}(?: \p{{Lu}}\.)?(?: {_NAME})?|(?<!\p{{L}})(?:{_TITLES})\.? ?\p{{IsHan}}{{2,3}}|(?<!\p{{L}})(?=\p{{Lu}})(?:{_GIVEN}) (?:\p{{Lu}}\. ?)?{_NAME}"
_CHINESE = rf"[{SURNAMES}]\p{{IsHan}}{{0,2}}?(?:{'|'.join(AFTER)})"
#: Type and pattern of each kind of entity; of those that match at a place, the first counts.
PATTERNS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b(?<=\d[A-Z0-9 ]{0,9})"),
    ("born", rf"(?<![\d/.-])(?=\d{{1,4}}[-/.]\d)(?<=(?i:born|birth|birthday|dob|d\.o\.b\.|née? le|geboren|geburtsdatum|naissance|nacido|nacida|nacimiento)[^\n\d]{{1,16}}){_DATE}(?![\d/-])"),
    ("passport", r"(?<![\w-])(?=[A-Z]{0,2}\d{6})(?<=(?i:passport|passeport|pasaporte|reisepass)[^\n\d]{1,16})[A-Z]{0,2}\d{6,9}(?!\w)"),
    ("ip", rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"),
    ("ip6", rf"(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]*\d)(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\w:])"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\d)|(?<![\w+])\+(?=(?:[ ().-]{0,2}\d){8,15}(?!\d))\d{1,3}(?:[ .-]{0,2}\(?\d{1,4}\)?){2,7}(?!\d)|(?<![\w.+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])|(?<![\w.+-])0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?![\w-])"),
    ("card", r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])"),
    ("ssn", r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("secret", r"(?<![0-9A-Za-z])(?=[a-fA-F]{0,63}\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])"),
    ("key", r"(?<![0-9A-Za-z_-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64})(?![0-9A-Za-z])"),
    ("street", rf"(?<![\w.-])\d{{1,5}} (?:{_NAME} ){{1,3}}(?:{_ROAD})(?!\p{{L}})"),
    ("person", _FIRST),
    ("chinese", _CHINESE),
)
#: All patterns as one. What an entity begins with is tested first, as most places of a text begin none.
_BY_FIRST = (("", ("email",)), (r"(?=[0-9A-Z+(])", ("iban", "born", "passport", "ip", "phone", "card", "ssn", "street")), (r"(?=[0-9A-Fa-f])", ("ip6", "secret")), (r"(?=[Ags])", ("key",)), (r"(?=\p{Lu})", ("person",)))
PATTERN = r"(?<![0-9A-Za-z])(?=[0-9A-Za-z+(._%-]|\p{Lu})(?:" + "|".join(f"{gate}(?:{'|'.join(f'(?:{p})' for k, p in PATTERNS if k in kinds)})" for gate, kinds in _BY_FIRST) + f")|(?:{_CHINESE})"
#: Patterns of entities that are found by what stands before them, without that.
BARE = {"born": _DATE, "passport": r"[A-Z]{0,2}\d{6,9}"}
#: What every entity has; most texts have none of it and need no further look.
HINT = rf"[0-9@]|(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{_TITLES})\.? ?[\p{{Lu}}\p{{IsHan}}]|(?:{_GIVEN}) \p{{Lu}})|[{''.join(k[-1] for k in AFTER)}](?<={'|'.join(AFTER)})"
#: Between the role and the word of a name in a list of entities. Roles: family (n) or given (m, f), Chinese names (hm, hf).
PART = "\x1f"


def let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def words(xs: list[str]) -> Column:
    """A constant array; one literal is made much faster than one for each word."""
    return F.split(F.lit(" ".join(xs)), " ")


def one_of(x: Column, xs: list[str]) -> Column:
    return F.array_contains(words(xs), x)


def kind(entity: Column) -> Column:
    out = F.lit("other")
    for name, p in reversed(PATTERNS):
        if name not in ("person", "chinese", "street"):
            out = F.when(entity.rlike(f"^(?:{BARE.get(name, p)})$"), F.lit(name)).otherwise(out)
    return F.when(entity.contains(PART), F.lit("name")).otherwise(out)


def number(key: str, *parts: Column) -> Column:
    """A keyed 48-bit number of the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), *(p.cast("string") for p in parts)), 256), 1, 12), 16, 10).cast("bigint")


def permuted(a: Column, b: Column, size_a: Column, size_b: Column, key: str, salt: Column) -> Column:
    """A pair of numbers below size_a and size_b after a keyed permutation of all such pairs that leaves none as it is:
    Feistel rounds, the next pair in order, and the rounds back (unless there is only one pair)."""

    def turn(sign: int):
        def one(s: Column, r: Column) -> Column:
            new_a = F.pmod(s["a"] + sign * F.pmod(number(key, salt, r, s["b"]), size_a), size_a)
            new_b = F.pmod(s["b"] + sign * F.pmod(number(key, salt, r, s["a"]), size_b), size_b)
            return F.when(r % 2 == 0, F.struct(new_a.alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), new_b.alias("b")))

        return one

    def after(s: Column) -> Column:
        up = s["b"] + 1 == size_b
        new_a = F.when(up, F.pmod(s["a"] + 1, size_a)).otherwise(s["a"])
        return F.struct(new_a.alias("a"), F.when(up, F.lit(0).cast("bigint")).otherwise(s["b"] + 1).alias("b"))

    there = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.alias("a"), b.alias("b")), turn(1), after)
    return F.aggregate(F.sequence(F.lit(ROUNDS - 1), F.lit(0)), there, turn(-1))


def digits(text: Column, key: str, salt: Column) -> Column:
    """The digits of a string of up to 36 of them, permuted among those of its length."""
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("bigint")

    def split(s: Column) -> Column:
        n_a = F.floor((F.length(s["d"]) + 1) / 2).cast("int")
        n_b = F.length(s["d"]) - n_a
        left, right = F.substring(s["d"], F.lit(1), n_a).cast("bigint"), F.coalesce(F.nullif(F.substring(s["d"], n_a + 1, n_b), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))
        joined = lambda p: F.concat(F.lpad(p["a"].cast("string"), n_a, "0"), F.when(n_b > 0, F.lpad(p["b"].cast("string"), n_b, "0")).otherwise(F.lit("")))
        return let(permuted(left, right, power(n_a), power(n_b), key, F.concat_ws(":", salt, F.length(s["d"]))), joined)

    return F.when(F.length(text) == 0, text).otherwise(let(F.struct(text.alias("d")), split))


def only(text: Column, what: str = "[^0-9]") -> Column:
    return F.regexp_replace(text, what, "")


def poured(shape: Column, new: Column) -> Column:
    """shape with its digits replaced, in order, by those of new."""
    step = lambda s, c: F.when(c.between("0", "9"), F.struct(F.concat(s["t"], F.substring(new, s["i"], F.lit(1))).alias("t"), (s["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(s["t"], c).alias("t"), s["i"].alias("i")))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")), step, lambda s: s["t"])


def luhn(d: Column) -> Column:
    """The Luhn sum of a digit string modulo 10."""
    one = lambda c, i: let(c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v))
    return F.pmod(F.aggregate(F.transform(F.split(F.reverse(d), ""), one), F.lit(0), lambda a, x: a + x), F.lit(10))


def dotted(entity: Column, key: str, salt: Column) -> Column:
    """An IPv4 address permuted among all."""

    def of(o: Column) -> Column:
        two = lambda i: o[i].cast("bigint") * 256 + o[i + 1].cast("bigint")
        size = F.lit(65536).cast("bigint")
        show = lambda x: F.concat_ws(".", F.shiftright(x, 8).cast("string"), (x % 256).cast("string"))
        return let(permuted(two(0), two(2), size, size, key, F.concat(salt, F.lit("ip"))), lambda p: F.concat_ws(".", show(p["a"]), show(p["b"])))

    return let(F.split(entity, r"\."), of)


def shaped(text: Column, key: str, salt: Column) -> Column:
    """Letters for letters and digits for digits, all else kept, from a keyed stream of the whole text."""

    def of(h: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            v = F.conv(F.substring(h, (i % 60) + 1, F.lit(4)), 16, 10).cast("int") + i
            letter = F.substring(F.lit(LETTERS), (v % 26) + 1, F.lit(1))
            return F.when(c.between("a", "z"), letter).when(c.between("A", "Z"), F.upper(letter)).when(c.between("0", "9"), (v % 10).cast("string")).otherwise(c)

        return F.array_join(F.transform(F.split(text, ""), one), "")

    return let(F.sha2(F.concat_ws("\x1f", F.lit(key), salt, text), 256), of)


def email(entity: Column, key: str, salt: Column, again: Column) -> Column:
    local, domain = F.regexp_extract(entity, "^([^@]*)@", 1), F.lower(F.regexp_extract(entity, "@(.*)$", 1))
    # a local part's stream also depends on the domain, and grows from the first collision on
    longer = F.when(again > 0, F.concat(F.lit("."), F.substring(F.translate(F.sha2(F.concat_ws("\x1f", F.lit(key), again.cast("string"), entity), 256), "0123456789", "ghijklmnop"), 1, 12))).otherwise(F.lit(""))
    host = F.concat(F.substring(F.translate(F.sha2(F.concat_ws("\x1f", F.lit(key), domain), 256), "0123456789", "ghijklmnop"), 1, 10), F.lit(".example."), F.regexp_extract(domain, r"([a-z]+)$", 1))
    return F.concat(shaped(local, key, F.concat(salt, domain)), longer, F.lit("@"), host)


def word_of(word: Column, role: Column, key: str, salt: Column) -> Column:
    """A name of the word's script and capitals; role n for family names, m and f for given ones."""

    def of(v: Column) -> Column:
        def build(script: str) -> Column:
            pick = lambda xs, by: F.get(words(xs), (F.shiftrightunsigned(v, by) % len(xs)).cast("int"))
            ends = F.when(role == "m", words(ENDS[script, "m"])).when(role == "f", words(ENDS[script, "f"])).otherwise(words(ENDS[script, "n"]))
            end = F.get(ends, (F.shiftrightunsigned(v, 30) % 6).cast("int"))
            return F.concat(pick(STARTS[script], 2), pick(MIDDLES[script], 10), pick(MIDDLES[script], 18), end)

        made = F.when(word.rlike(r"^\p{IsCyrillic}"), build("cyrillic")).when(word.rlike(r"^\p{IsGreek}"), build("greek")).otherwise(build("latin"))
        return let(made, lambda m: F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(m)).otherwise(m))

    return let(number(key, salt, role, word), of)


def chinese(word: Column, role: Column, key: str, salt: Column, again: Column) -> Column:
    """The family name shifted among SURNAMES, so that different ones stay so, and given ones of the gender."""
    first, n = F.substring(word, 1, 1), len(SURNAMES)
    at = F.instr(F.lit(SURNAMES), first)
    shift = number(key, F.lit("surnames")) % (n - 1) + 1
    family = F.when(at > 0, F.substring(F.lit(SURNAMES), ((at - 1 + shift) % n + 1).cast("int"), F.lit(1))).otherwise(first)

    def given(v: Column) -> Column:
        pick = lambda by: F.substring(F.when(role == "hf", F.lit(HAN["f"])).otherwise(F.lit(HAN["m"])), (F.shiftrightunsigned(v, by) % len(HAN["m"]) + 1).cast("int"), F.lit(1))
        long = F.length(word) + F.when(again > 0, 1).otherwise(0)
        return F.substring(F.concat(pick(2), pick(12), pick(22)), F.lit(1), long - 1)

    return F.concat(family, F.when(F.length(word) == 1, F.lit("")).otherwise(let(number(key, salt, role, word), given)))


def named(atom: Column, key: str, again: Column) -> Column:
    """The surrogate of a word of a name, written as role, PART and word."""

    def of(p: Column) -> Column:
        role, word, salt = p[0], p[1], again.cast("string")
        each = F.transform(F.when(again > 0, F.array(F.lit(""), salt)).otherwise(F.array(F.lit(""))), lambda x: word_of(word, F.when(x == "", role).otherwise(F.lit("n")), key, x))
        return F.when(role.startswith("h"), chinese(word, role, key, salt, again)).when(role == "d", digits(word, key, F.lit("street"))).otherwise(F.array_join(each, "-"))

    return let(F.split(atom, PART), of)


def name_parts(entity: Column) -> Column:
    """A person's name or a street's address as an array of role, PART and word; titles, initials and kinds of road have
    no role, numbers of houses d."""

    def western(w: Column) -> Column:
        title = F.regexp_replace(w[0], r"\.$", "")
        told = F.when(one_of(title, MALE), F.lit("m")).when(one_of(title, FEMALE), F.lit("f")).when(one_of(title, NEUTRAL), F.lit("u")).otherwise(F.lit(""))

        def role(x: Column, i: Column, told: Column) -> Column:
            given = F.when(one_of(x, GIVEN["m"]), F.lit("m")).when(one_of(x, GIVEN["f"]), F.lit("f")).when(told.isin("m", "f"), told).when(x.rlike("[aа]$"), F.lit("f")).otherwise(F.lit("m"))
            kept = ((i == 0) & (told != "")) | x.rlike(r"^\p{Lu}\.?$")
            han = F.concat(F.lit("h"), F.when(told == "f", F.lit("f")).otherwise(F.lit("m")))
            return F.when(kept, F.lit("")).when(x.rlike(r"^\p{IsHan}"), han).when(i == F.size(w) - 1, F.lit("n")).otherwise(given)

        return let(told, lambda t: F.transform(w, lambda x, i: F.concat(role(x, i, t), F.lit(PART), x)))

    spaced = F.regexp_replace(entity, rf"^((?:{_TITLES})\.?)(?=\p{{IsHan}})", "$1 ")
    after = F.regexp_extract(entity, rf"(?:{'|'.join(AFTER)})$", 0)
    gender = F.when(after.isin(*(k for k, v in AFTER.items() if v == "f")), F.lit("hf")).otherwise(F.lit("hm"))
    eastern = F.array(F.concat(gender, F.lit(PART), F.substring(entity, F.lit(1), F.length(entity) - F.length(after))), F.concat(F.lit(PART), after))
    road = lambda w: F.transform(w, lambda x, i: F.concat(F.when(i == 0, F.lit("d")).when(i == F.size(w) - 1, F.lit("")).otherwise(F.lit("n")), F.lit(PART), x))
    return F.when(after != "", eastern).otherwise(let(F.split(spaced, " "), lambda w: F.when(w[0].rlike(r"^\d"), road(w)).otherwise(western(w))))


def iban_check(compact: Column, body: Column) -> Column:
    """Check digits for a new body, moved from the right ones as far as those of the old number (without spaces) were."""

    def mod97(t: Column) -> Column:
        one = lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
        return F.aggregate(F.split(t, ""), F.lit(0), lambda a, c: one(a, c).cast("int"))

    rest = F.concat(F.substring(compact, 1, 2), F.lit("00"))
    old = F.substring(compact, F.lit(5), F.length(compact))
    move = mod97(F.concat(old, rest)) - mod97(F.concat(body, rest))
    return F.lpad(F.pmod(move + F.substring(compact, 3, 2).cast("int"), F.lit(100)).cast("string"), 2, "0")


def born(entity: Column, key: str, salt: Column) -> Column:
    """A date of the same form. Months of 120 years from 1900 on and days up to the 28th are permuted together; for later
    days the year alone, among leap years for a 29th of February; a date out of these ranges gets the first of them."""

    def of(p: Column) -> Column:
        iso = F.length(p[0]) == 4
        month_first = ~iso & (p[1].cast("int") > 12)
        place = F.when(iso, F.array(F.lit(0), F.lit(1), F.lit(2))).when(month_first, F.array(F.lit(2), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(2), F.lit(1), F.lit(0)))
        date = F.transform(place, lambda i: F.get(p, i).cast("bigint"))
        n = lambda x: F.lit(x).cast("bigint")

        def moved(x: Column) -> Column:
            y, m, d = x[0], x[1], x[2]
            fits = y.between(1900, 2019) & m.between(1, 12) & d.between(1, 31)
            late, leap = fits & (d > 28), fits & (d == 29) & (m == 2)
            from_ = F.when(leap, F.floor((y - 1904) / 4)).when(late, y - 1900).when(fits, (y - 1900) * 12 + m - 1).otherwise(n(0))
            of_days = F.when(fits & ~late, d - 1).otherwise(n(0))
            sizes = F.when(leap, n(29)).when(late, n(120)).otherwise(n(1440)), F.when(late, n(1)).otherwise(n(28))
            salted = F.concat_ws(":", salt, F.lit("born"), F.when(late, m), F.when(late, d))

            def shown(s: Column) -> Column:
                new = F.when(leap, F.array(s["a"] * 4 + 1904, m, d)).when(late, F.array(s["a"] + 1900, m, d)).otherwise(F.array(F.floor(s["a"] / 12) + 1900, s["a"] % 12 + 1, s["b"] + 1))
                padded = lambda v, like: F.lpad(v, F.greatest(F.length(like), F.length(v)), "0")
                put = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: padded(F.get(new, F.array_position(place, i).cast("int") - 1).cast("string"), F.get(p, i)))
                gaps = F.array(F.regexp_extract(entity, r"^\d+(.)", 1), F.regexp_extract(entity, r"(.)\d+$", 1), F.lit(""))
                return F.array_join(F.zip_with(put, gaps, lambda v, g: F.concat(v, g)), "")

            return let(permuted(from_, of_days, *sizes, key, salted), shown)

        return let(date, moved)

    return let(F.split(entity, "[-/.]"), of)


def hexed(entity: Column, key: str, salt: Column) -> Column:
    """Hexadecimal digits for others, from a keyed stream of the whole address."""

    def of(h: Column) -> Column:
        one = lambda c, i: F.when(c.rlike("[0-9a-f]"), F.substring(h, i + 1, F.lit(1))).when(c.rlike("[A-F]"), F.upper(F.substring(h, i + 1, F.lit(1)))).otherwise(c)
        return F.array_join(F.transform(F.split(entity, ""), one), "")

    return let(F.sha2(F.concat_ws("\x1f", F.lit(key), salt, F.lit("hex"), entity), 256), of)


def surrogate(atom: Column, key: str, again: Column) -> Column:
    """The replacement of an entity or of a word of a name; again is 0, or the round after earlier ones collided."""
    salt = again.cast("string")
    start = "^(AKIA|gh._|sk-)"
    code = r"^(?:\+\d{1,3}(?=[ .(-])|0(?=\d))"

    def of(s: Column) -> Column:
        e, t = s["e"], s["t"]
        is_ = lambda *k: t.isin(*k)
        # what keeps its form and gets permuted digits: the part of the entity, and what the permutation depends on
        compact = F.regexp_replace(e, " ", "")
        body = F.when(is_("card"), F.substring(only(e), F.lit(1), F.length(only(e)) - 1)).when(is_("iban"), F.substring(compact, F.lit(5), F.length(compact))).when(is_("phone"), F.regexp_replace(e, code, "")).otherwise(e)
        apart = F.when(is_("phone"), F.regexp_extract(e, code, 0)).when(is_("iban"), F.concat(F.substring(e, 1, 2), only(body, "[0-9]"))).otherwise(F.lit(""))
        new = digits(only(body), key, F.concat_ws(":", salt, t, apart))

        def filled(f: Column) -> Column:
            """The form with its new digits, and checksums as good as before."""
            b, n = f["b"], f["n"]
            last = F.pmod(luhn(only(e)) - luhn(F.concat(n, F.lit("0"))), F.lit(10)).cast("string")
            account = let(poured(b, n), lambda x: F.concat(iban_check(compact, x), only(x)))
            return F.when(is_("phone"), F.concat(F.regexp_extract(e, code, 0), poured(b, n))).otherwise(poured(e, F.when(is_("card"), F.concat(n, last)).when(is_("iban"), account).otherwise(n)))

        # what gets a keyed stream in its shape
        letters = F.when(is_("key"), F.concat(F.regexp_extract(e, start, 1), shaped(F.regexp_replace(e, start, ""), key, salt))).when(is_("secret"), secret(e, key, salt)).when(is_("ip6"), hexed(e, key, salt))
        out = F.when(is_("name"), named(e, key, again)).when(is_("email"), email(e, key, salt, again)).when(is_("ip"), dotted(e, key, salt)).when(is_("born"), born(e, key, salt)).when(is_("key", "secret", "ip6"), letters)
        return out.otherwise(let(F.struct(body.alias("b"), new.alias("n")), filled))

    return let(F.struct(atom.alias("e"), kind(atom).alias("t")), of)


def secret(entity: Column, key: str, salt: Column) -> Column:
    h = F.concat(*(F.sha2(F.concat_ws("\x1f", F.lit(key), salt, F.lit(i), entity), 256) for i in "ab"))
    new = F.substring(h, F.lit(1), F.length(entity))
    return F.when(entity == F.upper(entity), F.upper(new)).otherwise(new)


def entities(text: Column) -> Column:
    """All entities of a text in order; empty where it has none."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(none)


def has_names(entity: Column) -> Column:
    """Whether an entity is replaced word by word."""
    return entity.rlike("^(?:" + "|".join(f"(?:{p})" for k, p in PATTERNS if k in ("person", "chinese", "street")) + ")$")


def atoms(found: Column) -> Column:
    """What is replaced as one: entities, and each word of a name that has a role."""
    parts = lambda e: F.filter(name_parts(e), lambda p: ~p.startswith(PART))
    return F.flatten(F.transform(found, lambda e: F.when(has_names(e), parts(e)).otherwise(F.array(e))))


def original(atom: Column) -> Column:
    """An entity as it stands in the text."""
    return F.when(atom.contains(PART), F.substring_index(atom, PART, -1)).otherwise(atom)


def collisions(found: DataFrame, key: str, most_rounds: int = MOST_ROUNDS) -> DataFrame | None:
    """Of distinct atoms (column entity): those whose plain surrogates collide, with others instead; None if none.

    Groups by surrogate are counted before anything moves, so an entity that a third of all rows hold is one row. Only
    those that collide are replaced and joined in later rounds. Numbers, dates and dotted addresses are permuted without
    a fixed point, so they are checked against each other but not against originals, which may fill their whole space.
    Raises if some still collide after most_rounds.
    """
    found = found.filter(~F.col("entity").startswith("d" + PART))  # house numbers, distinct with their streets
    drawn = F.col("entity").contains(PART) | kind(F.col("entity")).isin("email", "secret", "key", "ip6")
    now = settled(found.select("entity", surrogate(F.col("entity"), key, F.lit(0)).alias("new"), F.lit(0).alias("again")))
    for k in range(1, most_rounds + 1):
        # names of either role share a space; case does not tell surrogates apart
        first = now.groupBy(F.lower("new").alias("low")).agg(F.min("entity").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        same = now.join(first, F.lower(now["new"]) == first["low"]).filter("entity <> first").select("entity")
        taken = now.filter(drawn).join(now.select(original(F.col("entity")).alias("other")).distinct(), F.col("new") == F.col("other"), "left_semi").select("entity")
        bad = settled(same.union(taken).distinct())
        if not bad.head(1):
            break
        moved = bad.select("entity", surrogate(F.col("entity"), key, F.lit(k)).alias("new"), F.lit(k).alias("again"))
        now = settled(now.join(bad, "entity", "left_anti").unionByName(moved))
    else:
        raise ValueError(f"surrogates still collide after {most_rounds} rounds")
    return now.filter("again > 0").select("entity", "new") if k > 1 else None


def replace(docs: DataFrame, key: str | None = None, text: str = "text") -> DataFrame:
    """docs with the entities of the text column replaced; all rows and columns are kept."""
    key = key if key is not None else secrets.token_hex(16)
    of = F.col(f"`{text}`").cast("string")
    distinct = docs.select(F.explode(atoms(entities(of))).alias("entity")).distinct()
    other = collisions(distinct, key)
    if other is None:
        return docs.withColumn(text, rewritten(of, key, None))
    few = other.limit(MOST_LISTED + 1).collect()
    if len(few) <= MOST_LISTED:
        known = F.from_json(F.lit(json.dumps({r.entity: r.new for r in few})), "map<string,string>")
        return docs.withColumn(text, rewritten(of, key, known))
    # texts with a colliding entity are told by the hash of their whole text; texts without entities do not move
    mark = F.sha2(of, 256)
    hit = docs.select(mark.alias("_mark"), F.explode(F.array_distinct(atoms(entities(of)))).alias("entity")).join(other, "entity")
    maps = hit.distinct().groupBy("_mark").agg(F.map_from_entries(F.collect_list(F.struct("entity", "new"))).alias("_known"))
    some = F.coalesce(F.size(entities(of)) > 0, F.lit(False))
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    at = docs.filter(some).alias("d").join(maps.alias("m"), F.sha2(F.col(f"d.`{text}`").cast("string"), 256) == F.col("m._mark"), "left")
    new = rewritten(F.col(f"d.`{text}`").cast("string"), key, F.col("m._known"))
    return docs.filter(~some).unionByName(at.select(*(new.alias(text) if c == text else n.alias(c) for c, n in zip(docs.columns, names))))


def rewritten(text: Column, key: str, known: Column | None) -> Column:
    """The text with all entities replaced, and other mentions of the names in it; known overrides plain surrogates.

    The text is cut into pieces to keep and atoms to replace, so that the replacement is one expression.
    """
    word = lambda p: F.substring_index(p, PART, -1)
    piece = lambda s, keep: F.struct(F.lit(keep).alias("keep"), s.alias("s"))

    def name_pieces(e: Column) -> Column:
        gap = F.when(e.contains(" "), F.lit(" ")).otherwise(F.lit(""))
        one = lambda p, first: F.array(piece(F.when(first, F.lit("")).otherwise(gap), True), F.struct(p.startswith(PART).alias("keep"), F.when(p.startswith(PART), word(p)).otherwise(p).alias("s")))
        return F.flatten(F.transform(name_parts(e), lambda p, i: one(p, i == 0)))

    def pieces(s: Column) -> Column:
        quoted = F.transform(s["names"], lambda p: F.when(word(p).rlike(r"^\p{IsHan}"), word(p)).otherwise(F.concat(F.lit(r"(?<!\p{L})"), word(p), F.lit(r"(?!\p{L})"))))
        pattern = F.concat_ws("|", F.lit(PATTERN), quoted)
        own = lambda e: F.get(F.filter(s["names"], lambda p: word(p) == e), F.lit(0))
        each = lambda e: F.when(has_names(e), name_pieces(e)).otherwise(F.array(piece(F.coalesce(own(e), e), False)))
        found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), each)
        kept = F.transform(F.split(text, pattern, -1), lambda t: F.array(piece(t, True)))
        return F.flatten(F.zip_with(kept, found, lambda t, e: F.when(e.isNull(), t).otherwise(F.concat(t, e))))

    def new(atom: Column) -> Column:
        plain = surrogate(atom, key, F.lit(0))
        return plain if known is None else F.coalesce(F.element_at(known, atom), plain)

    def of(found: Column) -> Column:
        words = F.filter(F.array_distinct(atoms(F.filter(found, lambda e: e.rlike(f"^(?:{_FIRST}|{_CHINESE})$")))), lambda p: F.length(word(p)) >= F.when(p.startswith("h"), 2).otherwise(3))
        joined = F.array_join(F.transform(let(F.struct(words.alias("names")), pieces), lambda x: F.when(x["keep"], x["s"]).otherwise(new(x["s"]))), "")
        return F.when(F.size(found) == 0, text).otherwise(joined)

    return F.when(text.isNotNull(), let(entities(text), of))
