r"""Personal data replaced by keyed, type-consistent surrogates.

One regular expression finds e-mail addresses, IP addresses, phone, card,
account and social-security numbers, secrets, and names (after a title in
either case, or a listed given name and a surname; with hyphens, apostrophes,
initials and particles).  Each distinct entity of the corpus, in a normal form
(letter case, separators and spacing aside; a ten-digit phone number is one of
country code 1), gets one surrogate drawn from a keyed hash, so mentions that
differ in form only, and names of one person (each part of a name is mapped by
itself), stay coreferent.  Where a document names a person, later single words
that equal a part of the name are replaced too:

* digits become digits, letters letters of the same script and case;
* an e-mail keeps its top-level domain and the case of its letters, its host is
  mapped by itself, collisions checked; a phone number keeps its country code, a card its first digit and a valid check
  digit if it had one, an IBAN its country and valid check digits, an AWS-style
  key its prefix, an IP address keeps valid octets;
* a given name keeps its script and its gender: that of the title, else of the
  list; an unlisted name after a title without gender may get either.

Collision checks: a surrogate that another entity of its type has drawn, or
that is an entity of the corpus itself, is drawn again; after some draws the
space is widened, so the loop ends.

Everything is DataFrame functions.  Texts are scanned once; only entities of
distinct texts are exploded and shuffled, and each text is rebuilt from its
pieces and a map of its own entities.

Cases: null texts stay null, empty ones empty; a text without entities is
unchanged; equal texts get equal results; a null id is kept; an empty table
gives no rows; a value after a keyword without a letter or digit (a mask) and
digits that read as a time stamp stay; particles and single letters of a name
stay; in capitals, two words after a title count as the name; a word that is a
part of two names of one document stands for the first of them in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import once, stored
from riskview.operators.joins import broadcast_if_small

#: Given names by script and gender, surnames' syllables by script, titles.
GIVEN = {
    ("latin", "f"): ("Anna", "Clara", "Elena", "Emma", "Julia", "Laura", "Lucia", "Maria", "Nina", "Paula", "Sara", "Sofia"),
    ("latin", "m"): ("Adam", "Daniel", "David", "Felix", "Jakob", "Jonas", "Lukas", "Martin", "Oscar", "Paul", "Simon", "Thomas"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Денис", "Иван", "Михаил", "Павел", "Сергей"),
    ("greek", "f"): ("Άννα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"),
    ("greek", "m"): ("Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
}
SYLLABLES = {"latin": ("ba", "den", "fer", "gal", "hol", "kin", "lor", "mar", "nes", "pol", "ron", "sel", "tam", "vin", "wes", "zor"),
             "cyrillic": ("ба", "вин", "гор", "ден", "зин", "кол", "лев", "мар", "нес", "пол", "рон", "сел", "том", "фед", "чер", "шин"),
             "greek": ("βα", "γερ", "δημ", "ζαν", "θεο", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ραφ", "σαμ", "τσο", "φιλ", "χατ", "ψαρ")}
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sir", "г-н", "господин", "κύριος"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Lady", "г-жа", "госпожа", "κυρία"),
          "": ("Dr", "Prof")}
#: Further given names that are recognised (none of them is drawn).
KNOWN = {"f": ("Alice", "Amanda", "Barbara", "Betty", "Camille", "Carmen", "Claire", "Deborah", "Donna", "Elizabeth", "Emily",
               "Greta", "Hannah", "Helen", "Ingrid", "Isabel", "Jane", "Jennifer", "Jessica", "Karen", "Katherine", "Linda", "Lisa",
               "Margaret", "Marie", "Mary", "Melissa", "Michelle", "Monika", "Nancy", "Patricia", "Petra", "Rebecca", "Ruth",
               "Sandra", "Sarah", "Stephanie", "Susan"),
         "m": ("Andrew", "Anthony", "Antoine", "Brian", "Carlos", "Charles", "Christopher", "Edward", "George", "Hans", "James",
               "Jason", "Jeffrey", "John", "José", "Joseph", "Joshua", "Juan", "Jürgen", "Karl", "Kenneth", "Kevin", "Klaus", "Louis",
               "Luis", "Matthew", "Michael", "Miguel", "Pedro", "Peter", "Pierre", "Richard", "Robert", "Ronald", "Stefan", "Steven",
               "Timothy", "William")}
PARTICLES = ("von", "van", "der", "den", "de", "del", "della", "da", "di", "la", "le", "du", "al", "bin", "zu")

_EDGE = r"(?<![\p{L}\p{N}_])"
_WOMEN = [n for (_, g), names in GIVEN.items() if g == "f" for n in names] + list(KNOWN["f"])
_MEN = [n for (_, g), names in GIVEN.items() if g == "m" for n in names] + list(KNOWN["m"])
_GIVEN = "|".join(_WOMEN + _MEN)
#: Titles that are words of their own in lower case count only as they are written here.
_STRICT = ("Ms", "Miss", "Sir", "Lady")
_TITLE = ("(?iu:" + "|".join(t for names in TITLES.values() for t in names if t not in _STRICT) + "|ms(?=\\.))|" + "|".join(_STRICT))
_PART = rf"(?:(?:{'|'.join(PARTICLES)})\x20)*+"
_CAP = r"\p{Lu}(?:\p{L}++(?:['’-]\p{Lu}\p{L}*+)*+|(?:['’-]\p{Lu}\p{L}++)++)"
#: Seconds and milliseconds of an epoch, and dates with a time, as bare digits.
_STAMP = (r"(?:1[0-9]{9}(?:[0-9]{3})?|(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])"
          r"(?:[01][0-9]|2[0-3])[0-5][0-9](?:[0-5][0-9])?)(?![\p{L}\p{N}])")
#: Patterns by type, in the order in which they are tried.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)++\p{L}{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "aws": r"A(?:KIA|SIA)[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,4}(?![\p{L}\p{N}])"
             r"|\(?[0-9]{3}\)[\x20.-]?[0-9]{3}[.-][0-9]{4}(?![\p{L}\p{N}])|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\p{L}\p{N}])",
    "ssn": r"(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})(?![\p{L}\p{N}])",
    "ip": r"(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])",
    "card": rf"(?!{_STAMP})(?:[0-9]{{4}}(?:[\x20-]?[0-9]{{4}}){{2}}[\x20-]?[0-9]{{1,7}}|[0-9]{{10,19}})(?![\p{{L}}\p{{N}}])",
    "secret": r"(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}(?![\p{L}\p{N}])",
    "name": rf"(?:(?:{_TITLE})\.?\x20)++(?:\p{{Lu}}\.\x20)*+{_PART}{_CAP}(?:\x20(?:\p{{Lu}}\.\x20)*+{_PART}{_CAP})?"
            rf"|(?=\p{{Lu}})(?:{_GIVEN})(?:-\p{{Lu}}\p{{L}}++)?\x20(?:\p{{Lu}}\.\x20)*+{_PART}{_CAP}"
            rf"|(?=\p{{Lu}}{{2}})(?:{_GIVEN.upper()})\x20\p{{Lu}}{{2,}}+(?:['’-]\p{{Lu}}++)*+(?!\p{{L}})",
}
#: A value after a keyword goes first, or another type would take a part of it; marks that end a sentence stay outside.
_VALUE = (r"(?<=[=:]\x20?[\x22']?)(?<=(?i:password|passwd|token|secret|api_key)\x20?[=:]\x20?[\x22']?)"
          r"(?=[^\s\x22']{8})(?=[^\s\x22']*[\p{L}\p{N}])[^\s\x22']*[^\s\x22'.,;:!?)\]}]")
ENTITY = "(?:" + _VALUE + "|" + _EDGE + "(?:" + "|".join(PATTERNS.values()) + "))"
_CUT, _ESCAPE = "\u0002", "\u0003"  # a cut is set around entities; both are escaped in texts that hold them
_WIDER = 8  # draws after which the space is widened
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _pieces(text: Column) -> Column:
    """Text and entities in turn: the pieces with odd index are entities."""
    safe = F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "a")), F.lit(_CUT), F.lit(_ESCAPE + "b"))
    safe = F.when(text.rlike(f"[{_CUT}{_ESCAPE}]"), safe).otherwise(text)
    return F.split(F.regexp_replace(safe, ENTITY, _CUT + "$0" + _CUT), _CUT)


def _joined(text: Column, pieces: Column) -> Column:
    """Pieces back to a text; ``text`` is the one they come from."""
    whole = F.array_join(pieces, "")
    plain = F.replace(F.replace(whole, F.lit(_ESCAPE + "b"), F.lit(_CUT)), F.lit(_ESCAPE + "a"), F.lit(_ESCAPE))
    return F.when(text.rlike(f"[{_CUT}{_ESCAPE}]"), plain).otherwise(whole)


def _type(entity: Column) -> Column:
    out = F.lit("secret")
    for kind in reversed([k for k in PATTERNS if k != "secret"]):
        out = F.when(entity.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def _normal(kind: Column, entity: Column) -> Column:
    """Form under which mentions are the same entity."""
    return (F.when(kind == "email", F.lower(entity))
            .when((kind == "phone") & ~entity.startswith("+"), F.concat(F.lit("1"), F.regexp_replace(entity, "[^0-9]", "")))
            .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, "[^0-9]", ""))
            .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
            .otherwise(entity))


def _noise(key: str, *parts: Column) -> Column:
    """Keyed pseudo-random numbers 0 to 65535, sixteen a hash, as an array."""
    def block(n: int) -> Column:
        h = F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit(str(n)), *[p.cast("string") for p in parts]), 256)
        return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substring(h, i * 4 + 1, F.lit(4)), 16, 10).cast("int"))
    return F.concat(*[block(n) for n in range(5)])


def _pick(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), number % len(alphabet) + 1, F.lit(1))


def _letters(text: Column, noise: Column, hexed: Column) -> Column:
    """Every letter and digit of ``text`` drawn anew, script and case kept;
    other characters stay.  ``hexed``: letters are hexadecimal digits."""
    def one(c: Column, i: Column) -> Column:
        n = F.element_at(noise, (i % 80 + 1).cast("int")) + (i / 80).cast("int") * 7
        return (F.when(hexed & c.rlike("[0-9a-f]"), _pick("0123456789abcdef", n))
                .when(c.rlike("[0-9]"), _pick(_DIGITS, n))
                .when(c.rlike("[a-z]"), _pick(_LOWER, n)).when(c.rlike("[A-Z]"), _pick(_UPPER, n))
                .when(c.rlike(r"\p{IsCyrillic}"), F.when(c == F.lower(c), _pick("абвгдежзиклмнопрстуфхцчшэюя", n))
                      .otherwise(_pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", n)))
                .when(c.rlike(r"\p{IsGreek}"), F.when(c == F.lower(c), _pick("αβγδεζηθικλμνξοπρστυφχψω", n))
                      .otherwise(_pick("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", n)))
                .when(c.rlike(r"\p{Ll}"), _pick("àáâäèéêëìíîïòóôöùúûü", n)).when(c.rlike(r"\p{Lu}"), _pick("ÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ", n))
                .otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, modulo 10."""
    def add(acc: Column, x: Column) -> Column:
        d = x["d"] * (x["i"] % 2 + 1)
        return acc + F.when(d > 9, d - 9).otherwise(d)
    seen = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(seen, F.lit(0), add) % 10


def _mod97(text: Column) -> Column:
    """An IBAN's text, first four characters moved to the end, modulo 97."""
    moved = F.concat(F.substr(text, F.lit(5)), F.substring(text, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (F.when(value > 9, acc * 100).otherwise(acc * 10) + value) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), add)


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(given: Column) -> Column:
    return F.when(given.isin(_WOMEN), "f").when(given.isin(_MEN), "m")


def _bare(kind: Column, normal: Column) -> Column:
    """A normal form as it may stand in a text: a given name without its gender."""
    return F.when(kind == "given", F.substr(normal, F.lit(3))).otherwise(normal)


def _drawn(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """The surrogate of an entity's normal form at its ``attempt``-th draw."""
    return once(_noise(key, kind, normal, attempt), lambda noise: once(
        _letters(normal, noise, F.lit(False)), lambda digits: _surrogate(key, kind, normal, attempt, noise, digits)))


def _surrogate(key: str, kind: Column, normal: Column, attempt: Column, noise: Column, digits: Column) -> Column:
    """``digits``: the normal form with its letters and digits drawn anew."""
    wide = F.when(attempt >= _WIDER, F.substring(F.sha2(F.concat_ws("\u0001", F.lit(key), normal, attempt.cast("string")), 256), 1, 8)).otherwise("")
    at = lambda i: F.element_at(noise, i)
    email = F.concat(F.substring_index(digits, "@", 1), wide, F.lit("@"), F.substring_index(normal, "@", -1))  # its host is drawn apart
    top = F.substring_index(normal, ".", -1)
    host = F.concat(wide, F.substring(digits, F.lit(1), F.length(digits) - F.length(top)), top)
    code = F.greatest(F.length(normal) - 10, F.lit(0))
    phone = F.concat(F.substring(normal, F.lit(1), code), _pick("23456789", at(70)), F.substr(digits, code + 2))
    stem = F.concat(F.substring(normal, 1, 1), F.substring(digits, F.lit(2), F.length(digits) - 2))
    checked = once(stem, lambda s: F.concat(s, ((F.lit(10) - _luhn(F.concat(s, F.lit("0")))) % 10).cast("string")))
    card = F.when(_luhn(normal) == 0, checked).otherwise(F.concat(F.substring(normal, 1, 1), F.substr(digits, F.lit(2))))
    ssn = F.concat(_pick("12345678", at(70)), F.substr(digits, F.lit(2)))
    body = F.substr(digits, F.lit(5))
    country = F.substring(normal, 1, 2)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0"), body)
    iban = F.when(_mod97(normal) == 1, iban).otherwise(F.concat(country, F.substr(digits, F.lit(3))))

    def octet(c: Column, i: Column) -> Column:
        n = F.element_at(noise, i + 1)
        return (F.when((F.length(c) == 1) & (attempt < _WIDER), n % 9 + 1).when((F.length(c) == 2) & (attempt < _WIDER), n % 90 + 10)
                .when(attempt < _WIDER, n % 155 + 100).otherwise(n % 254 + 1)).cast("string")
    ip = F.array_join(F.transform(F.split(normal, r"\."), octet), ".")
    hexed = lambda c: _letters(c, noise, F.lit(True))
    secret = F.concat(F.when(normal.rlike("^[0-9a-f]+$"), hexed(normal)).when(normal.rlike("^[0-9A-F]+$"), F.upper(hexed(F.lower(normal))))
                      .otherwise(digits), wide)
    aws = F.concat(F.substring(normal, 1, 4), F.substr(_letters(F.translate(normal, _DIGITS, "ABCDEFGHIJ"), noise, F.lit(False)), F.lit(5)))
    syllables = lambda k: F.element_at(F.element_at(F.create_map(*[x for s, v in SYLLABLES.items() for x in (F.lit(s), F.array(*map(F.lit, v)))]),
                                                    _script(normal)), at(k) % 16 + 1)
    extra = F.when(attempt > 2, F.concat(syllables(5), F.when(attempt > 5, syllables(6)).otherwise(""))).otherwise("")
    surname = F.initcap(F.concat(syllables(1), syllables(2), syllables(3), extra, F.when(attempt >= _WIDER, syllables(8)).otherwise("")))
    both = {(s, "n"): GIVEN[s, "f"] + GIVEN[s, "m"] for s in SYLLABLES}
    pools = F.create_map(*[x for (s, g), v in {**GIVEN, **both}.items() for x in (F.lit(s + g), F.array(*map(F.lit, v)))])
    pool = F.element_at(pools, F.concat(_script(normal), F.substring(normal, 1, 1)))  # a given name's normal form begins with its gender
    given = F.concat(F.element_at(pool, at(4) % F.size(pool) + 1), F.when(attempt > 2, F.concat(F.lit("-"), F.initcap(F.concat(syllables(5), extra)))).otherwise(""))
    return (F.when(kind == "email", email).when(kind == "host", host).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", ssn)
            .when(kind == "iban", iban).when(kind == "ip", ip).when(kind == "aws", aws).when(kind == "given", given)
            .when(kind == "surname", surname).otherwise(secret))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities(kind, normal)``, distinct, with a surrogate each: no two of a
    kind alike, none that is an entity of its kind."""
    done = None
    taken = entities.select("kind", _bare(F.col("kind"), F.col("normal")).alias("surrogate"))
    open_, attempt = entities, 0
    while True:
        draw = open_.select("kind", "normal", _drawn(key, F.col("kind"), F.col("normal"), F.lit(attempt)).alias("surrogate"))
        draw = stored(draw, "draws")
        first = draw.groupBy("kind", "surrogate").agg(F.min("normal").alias("normal"))
        good = first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "normal", "surrogate")
        good = stored(good, "drawn")
        done = good if done is None else done.union(good)
        open_ = stored(draw.select("kind", "normal").join(good.select("kind", "normal"), ["kind", "normal"], "left_anti"), "again")
        if open_.isEmpty():
            return stored(done, "surrogates")
        taken, attempt = taken.union(good.select("kind", "surrogate")), attempt + 1


def _filled(entity: Column, digits: Column) -> Column:
    """A mention's digits replaced by a surrogate's, in turn; the rest of a
    longer surrogate follows."""
    out = F.aggregate(F.split(entity, ""), F.struct(F.lit("").alias("s"), F.lit(0).alias("n")), lambda acc, c: F.struct(
        F.concat(acc["s"], F.when(c.rlike("[0-9A-Z]"), F.substring(digits, acc["n"] + 1, F.lit(1))).otherwise(c)).alias("s"),
        (acc["n"] + F.when(c.rlike("[0-9A-Z]"), 1).otherwise(0)).alias("n")))
    return out["s"]


def _cased(mention: Column, word: Column) -> Column:
    """``word`` with the case of a mention: all capitals, else letter by letter."""
    each = F.transform(F.split(word, ""), lambda c, i: F.when(F.substring(mention, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))
    return F.when(F.upper(mention) == mention, F.upper(word)).otherwise(F.array_join(each, ""))


def _name_cased(mention: Column, word: Column) -> Column:
    return F.when((F.upper(mention) == mention) & (F.length(mention) > 1), F.upper(word)).otherwise(word)


def _title(entity: Column) -> Column:
    return F.regexp_extract(entity, rf"^((?:(?:{_TITLE})\.?\x20)+)", 1)


def _name_parts(entity: Column) -> Column:
    """The parts of a name after its title, in turn: ``text``, and for words
    that are replaced ``kind`` (given, surname) and ``normal``; the rest
    (blanks, marks, particles, initials) has no kind."""
    title = _title(entity)
    words = F.split(F.substr(entity, F.length(title) + 1), " ")
    titled = F.lit(None).cast("string")
    for g in ("m", "f"):
        titled = F.when(title.rlike(rf"(?iu)(?:^|\x20)(?:{'|'.join(TITLES[g])})[.\x20]"), g).otherwise(titled)
    proper = lambda t: F.initcap(F.lower(t))

    def cell(kind: Column, normal: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), normal.alias("normal"), text.alias("text"))

    def word(w: Column, i: Column) -> Column:
        first = F.substring_index(w, "-", 1)
        given = (i == 0) & ((F.size(words) > 1) | _gender(proper(first)).isNotNull())
        parts = F.transform(F.split(w, "(?<=['’-])|(?=['’-])"), lambda t: F.when(
            t.rlike(r"^\p{Lu}\p{L}+$"), F.when(given, cell(
                F.lit("given"), F.concat(F.coalesce(titled, _gender(proper(first)), F.lit("n")), F.lit(":"), proper(t)), t))
            .otherwise(cell(F.lit("surname"), proper(t), t))).otherwise(cell(F.lit(""), F.lit(""), t)))
        blank = cell(F.lit(""), F.lit(""), F.lit(" "))
        return F.when(i > 0, F.concat(F.array(blank), parts)).otherwise(parts)
    return F.flatten(F.transform(words, word))


#: Between a word and what is none.
_BOUND = r"(?<=[\p{L}\p{M}\p{N}_])(?![\p{L}\p{M}\p{N}_])|(?<![\p{L}\p{M}\p{N}_])(?=[\p{L}\p{M}\p{N}_])"


def _later(piece: Column, names: Column) -> Column:
    """Single capitalised words that are a part of one of the document's names,
    replaced alike."""
    def one(w: Column) -> Column:
        known = once(F.element_at(names, F.initcap(F.lower(w))), lambda to: _name_cased(w, to))
        return F.when(w.rlike(r"^\p{Lu}\p{L}+$"), F.coalesce(known, w)).otherwise(w)
    return F.array_join(F.transform(F.split(piece, _BOUND), one), "")


def _swapped(rows: DataFrame, key: str) -> DataFrame:
    """``rows(row, text)`` with entities replaced: row, text, n_entities, kinds."""
    pieces = _pieces(F.col("text"))
    # equal texts have equal entities: one row a text, so copies cost one
    texts = (rows.select(F.md5("text").alias("key"), pieces.alias("pieces")).where(F.size("pieces") > 1)
             .groupBy("key").agg(F.first("pieces").alias("pieces")))
    inner = F.array_distinct(F.filter("pieces", lambda p, i: i % 2 == 1))
    texts = stored(texts.select("key", inner.alias("entities")), "entities")
    mentions = texts.select(F.explode("entities").alias("entity")).distinct().withColumn("kind", _type(F.col("entity")))
    entity, kind = F.col("entity"), F.col("kind")
    normal = _normal(kind, entity)
    cell = lambda k, n: F.struct(k.alias("kind"), n.alias("normal"), entity.alias("text"))
    parts = (F.when(kind == "name", _name_parts(entity))
             .when(kind == "email", F.array(cell(kind, normal), cell(F.lit("host"), F.substring_index(normal, "@", -1))))
             .otherwise(F.array(cell(kind, normal))))
    mentions = stored(mentions.select("entity", kind.alias("type"), F.posexplode(parts).alias("at", "part")).where("part.kind <> ''")
                      .select("entity", "type", "at", "part.kind", "part.normal"), "mentions")
    drawn = surrogates(mentions.select("kind", "normal").distinct(), key)
    name_part = F.when(kind.isin("given", "surname"), F.struct(_bare(kind, F.col("normal")).alias("word"), F.col("surrogate").alias("to")))
    made = (mentions.join(drawn, ["kind", "normal"]).groupBy("entity", "type")  # a handful of parts each
            .agg(F.map_from_entries(F.collect_list(F.struct("at", "surrogate"))).alias("drawn"), F.collect_list(name_part).alias("names")))
    one = F.element_at("drawn", F.lit(0))
    name = F.concat(_title(entity), F.array_join(F.transform(_name_parts(entity), lambda p, i: F.when(
        p["kind"] != "", _name_cased(p["text"], F.element_at(F.col("drawn"), i))).otherwise(p["text"])), ""))
    made = made.select("entity", "type", "names", F.when(F.col("type") == "name", name)
                       .when((F.col("type") == "phone") & ~entity.startswith("+"), _filled(entity, F.substr(one, F.lit(2))))
                       .when(F.col("type").isin("phone", "card", "ssn", "iban"), _filled(entity, one))
                       .when(F.col("type") == "email", _cased(entity, F.concat(
                           F.substring_index(one, "@", 1), F.lit("@"), F.element_at("drawn", F.lit(1)))))
                       .otherwise(one).alias("surrogate"))
    made = stored(made, "made")
    names = F.array_sort(F.flatten(F.collect_list("names")))
    maps = (texts.select("key", F.explode("entities").alias("entity")).join(made, "entity").groupBy("key")
            .agg(F.map_from_entries(F.collect_list(F.struct("entity", F.struct("type", "surrogate")))).alias("by"), names.alias("names")))
    first = F.filter("names", lambda p, i: (i == 0) | (F.get(F.col("names"), i - 1)["word"] != p["word"]))
    maps = maps.withColumn("names", F.map_from_entries(first))
    maps = broadcast_if_small(stored(maps, "maps"), 100_000)
    out = rows.withColumn("key", F.md5("text")).join(maps, "key", "left")
    out = out.withColumn("pieces", F.when(F.col("by").isNotNull(), pieces))
    swapped = F.transform("pieces", lambda p, i: F.when(i % 2 == 1, F.element_at("by", p)["surrogate"])
                          .when(F.size("names") > 0, _later(p, F.col("names"))).otherwise(p))
    kinds = F.sort_array(F.transform(F.filter("pieces", lambda p, i: i % 2 == 1), lambda p: F.element_at("by", p)["type"]))
    plain = F.col("by").isNull()
    return out.select("row", F.when(plain, F.col("text")).otherwise(_joined(F.col("text"), swapped)).alias("text"),
                      F.when(plain, F.lit(0)).otherwise(F.size(kinds)).cast("long").alias("n_entities"),
                      F.coalesce(kinds, F.array().cast("array<string>")).alias("kinds"))


def redact(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its entities replaced: id, text, n_entities, and
    kinds (sorted, one entry an entity; later single words of a name are
    replaced but not counted)."""
    out = _swapped(docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text")), key)
    return out.withColumnRenamed("row", id_col)


def redact_table(docs: DataFrame, key: str, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents, all columns, with entities replaced in the text and its
    length, if there is such a column, brought up to date."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]  # names may hold dots
    out = _swapped(docs.select(F.struct(*quoted).alias("row"), F.col(text_col).alias("text")), key)
    new = {text_col: F.col("text"), length_col: F.length("text").cast(dict(docs.dtypes).get(length_col, "long"))}
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
