"""Personal data replaced by keyed surrogates of the same type, in DataFrame functions only.

Detected entities are cut into pieces (a person is a given and a family name; anything else is one piece). Each distinct
piece of the corpus gets a surrogate from a keyed hash that keeps its format, script and gender. A collision check over
the table of distinct pieces gives another attempt to every piece whose surrogate is already someone's surrogate or
someone's real data, so that different pieces stay different; equal pieces share one surrogate wherever they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.staging import let, staged

#: fixed values: given names that mark a person, by gender; surrogates are built from syllables, not from these
FEMALE = ("Alice Amelia Ana Anna Anne Barbara Carmen Carol Caroline Catherine Charlotte Christine Claire Claudia Diana "
          "Elena Elisabeth Elizabeth Emily Emma Eva Fatima Grace Hannah Helen Ines Isabel Jane Jennifer Jessica Julia "
          "Karen Katharina Laura Linda Lisa Lucia Maria Marie Martha Mary Nancy Nina Olivia Patricia Rachel Rebecca Sarah "
          "Sofia Sophie Susan Ursula Анна Елена Мария Наталья Ольга Татьяна").split()
MALE = ("Adam Alexander Andreas Andrew Anthony Antonio Benjamin Carlos Charles Christopher Daniel David Edward Eric "
        "Francisco Frank Fritz George Hans Henry Jack Jacques James Javier Jean Johann John José Joseph Juan Karl Kevin "
        "Klaus Lucas Luis Manuel Mark Martin Matthew Michael Miguel Paul Pedro Peter Philip Pierre Richard Robert Samuel "
        "Stefan Steven Thomas William Wolfgang Александр Алексей Дмитрий Иван Сергей").split()
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
OTHER_TITLES = ("Dr", "Prof")

_TITLE = "|".join(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES)
_GIVEN = "|".join(FEMALE + MALE)
_NAME = r"\p{Lu}[\p{Ll}'’-]+(?:-\p{Lu}\p{Ll}+)?"
#: what ends here holds seven digits; spelled out because a look-behind takes no repeated group
_SEVEN = "(?<=" + "[0-9][ .()-]{0,3}" * 6 + r"[0-9]\)?)"
#: (type, pattern) in order of precedence
PATTERNS = (
    ("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[\s\S]*?-----END [A-Z ]{0,20}PRIVATE KEY-----"),
    ("token", r"\beyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{5,}|\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{30,}\b"
              r"|\bxox[abprs]-[\w-]{10,}|\bsk-[\w-]{16,}|\bAIza[\w-]{30,}"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|passphrase|token|secret|secret_key|api[_-]?key|access[_-]?key))['\"]?\s{0,3}[=:]"
               r"\s{0,3}['\"]?(?=[^\s'\",;]{0,200}[0-9])[^\s'\",;]{6,}"),
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b(?<=[0-9][A-Z0-9 ]{8,40})"),
    ("ip6", r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    ("ip4", r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9])"),
    ("card", r"(?<![\w.])[3-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![\w])|(?<![\w.])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?!\w)"),
    ("ssn", r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    ("phone", r"(?<![\w+.])\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?![\w])" + _SEVEN + r"|(?<![\w(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?!\w)"
              r"|(?<![\w.+-])[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}(?![\w-])"),
    ("person", rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}])(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_GIVEN}) {_NAME})"),
)
#: one pattern that finds all; its back-reference is spelled out because the parts lose their own groups. No part but the
#: first begins right after an ASCII letter or digit, which is looked at first; beyond that each keeps its own boundary
ANY = rf"(?:{PATTERNS[0][1]})|(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{p})" for _, p in PATTERNS[1:]).replace(
    r"([.-])[0-9]{3}\1[0-9]{4}", r"(?:\.[0-9]{3}\.|-[0-9]{3}-)[0-9]{4}") + ")"
PERSON = PATTERNS[-1][1]
#: what every match of a pattern but a person's holds: a digit, an at sign, the head of a key or token, a group of hex letters
#: between colons
SIGNS = r"[0-9@]|-----BEGIN|eyJ|AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk-|AIza|:[A-Fa-f]{1,4}:"

#: fixed values: alphabets whose letters stand in for each other
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзиклмнопрстуфхцчшщэюя",
             "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
#: fixed values: (consonants, vowels, endings for female, male and other given names, and family names) by script
SYLLABLES = {
    "latin": ("bdfgklmnprstvz", "aeiou", ("a", "ia", "ina", "elle"), ("o", "an", "ik", "us"), ("en", "ei", "ou", "in"),
              ("er", "son", "ov", "ez")),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("а", "ия", "ина", "ела"), ("ан", "ий", "ор", "ей"), ("ен", "ин", "ол", "эй"),
                 ("ко", "юк", "ян", "их")),
}
#: from this attempt on every further one makes surrogates longer by a character, so that no set of values can exhaust them
LONGER_FROM = 8
#: never met by the kinds that grow; addresses of fixed length and cards have more than a thousand million surrogates
MOST_ATTEMPTS = 40
#: fixed values: calling codes of one and two digits; all others have three
CALLING_CODES = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"


def _stream(key: str, kind: Column, norm: Column, attempt: Column, chars: Column) -> Column:
    """Keyed bytes as one long hex string, two digits for each of ``chars`` characters."""
    seed = F.concat_ws("|", kind, norm, attempt.cast("string"))
    inner = F.sha2(F.concat_ws("|", F.lit(key), seed), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(chars / 32).cast("int")), lambda i: F.sha2(
        F.concat_ws("|", F.lit(key), inner, i.cast("string")), 256)), "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _replaced(form: Column, stream: Column, skip: Column | None = None) -> Column:
    """Letters and digits from ``skip`` characters on replaced within their alphabet; the rest stays."""
    skip = F.lit(0) if skip is None else skip

    def letter(c, i):
        r = _byte(stream, i)
        of = lambda letters: F.substr(F.lit(letters), r % len(letters) + 1, F.lit(1))
        out = F.when(i < skip, c)
        for letters in ALPHABETS[:3]:
            out = out.when((c >= letters[0]) & (c <= letters[-1]), of(letters))
        out = out.when(c < "\x80", c)
        for letters in ALPHABETS[3:]:
            out = out.when(F.instr(F.lit(letters), c) > 0, of(letters))
        # letters of other scripts and with accents become plain ones of their case
        return out.when(c.rlike(r"\p{Lu}"), of(ALPHABETS[2])).when(c.rlike(r"\p{L}"), of(ALPHABETS[1])).otherwise(c)

    return F.array_join(F.transform(F.split(form, ""), letter), "")


def _name(form: Column, stream: Column, kind: Column, attempt: Column) -> Column:
    """A name of two or more syllables with the ending of its kind, in the script and case of ``form``."""
    def spelled(script):
        consonants, vowels, female, male, other, family = SYLLABLES[script]

        def pick(of, i):
            return F.element_at(F.array(*[F.lit(x) for x in of]), _byte(stream, i) % len(of) + 1)

        body = F.array_join(F.transform(F.sequence(F.lit(0), F.least(attempt + 1, F.lit(12))),
                                        lambda i: F.concat(pick(consonants, i * 2), pick(vowels, i * 2 + 1))), "")
        last, at = F.concat(pick(consonants, F.lit(26))), F.lit(27)
        end = F.when(kind == "given_f", pick(female, at)).when(kind == "given_m", pick(male, at)).when(
            kind == "given", pick(other, at)).otherwise(pick(family, at))
        return F.concat(body, last, end)

    name = F.when(form.rlike(r"\p{IsCyrillic}"), spelled("cyrillic")).otherwise(spelled("latin"))
    return F.when((F.length(form) > 1) & (form == F.upper(form)), F.upper(name)).when(
        F.substr(form, F.lit(1), F.lit(1)) == F.lower(F.substr(form, F.lit(1), F.lit(1))), name).otherwise(F.initcap(name))


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a string of digits."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int"))), F.lit(0), lambda a, x: a + x) % 10


def normal_form(kind: Column, form: Column) -> Column:
    """What makes two spellings the same entity: digits of numbers (and a phone's plus), lower case of names and addresses."""
    return F.when(kind.isin("card", "ssn"), F.regexp_replace(form, "[^0-9]", "")).when(
        kind == "phone", F.regexp_replace(form, "[^0-9+]", "")).when(
        kind.isin("email", "ip6", "given_f", "given_m", "given", "family"), F.lower(form)).when(
        kind == "iban", F.regexp_replace(form, " ", "")).otherwise(form)


def surrogate(key: str, kind: Column, form: Column, norm: Column, attempt: Column) -> Column:
    """The stand-in for ``form``, a spelling of the piece ``norm``; other spellings of it get the same letters and digits."""
    def made(s):
        # drawn on the norm, whose characters are those of the form that ``of`` names, and laid into the form
        laid = lambda of, lead: let(_replaced(norm, s, lead), lambda d: F.array_join(F.transform(
            F.split(form, ""), lambda c, i: F.when(c.rlike(f"[{of}]"), F.substr(
                d, F.length(F.regexp_replace(F.substr(form, F.lit(1), i + 1), f"[^{of}]", "")), F.lit(1))).otherwise(c)), ""))
        # a number keeps its country code or issuer digit; a valid card stays valid by its last digit
        lead = F.when(norm.startswith("+"), 1 + F.coalesce(F.nullif(F.length(F.regexp_extract(
            norm, rf"^\+({CALLING_CODES})", 1)), F.lit(0)), F.lit(3))).otherwise(F.lit(0))
        card = let(_replaced(norm, s, F.lit(1)), lambda d: let(F.concat(F.substr(d, F.lit(1), F.length(d) - 1), F.lit("0")), lambda z:
                   F.concat(F.substr(z, F.lit(1), F.length(z) - 1), ((10 - _luhn(z)) % 10).cast("string"))))
        card = let(card, lambda d: F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(
            c.rlike("[0-9]"), F.substr(d, F.length(F.regexp_replace(F.substr(form, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))
        ).otherwise(c)), ""))
        octets = F.array_join(F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: F.when(
            i == 0, 1 + _byte(s, i * 2) % 223).otherwise((_byte(s, i * 2) * 256 + _byte(s, i * 2 + 1)) % 254 + 1).cast("string")), ".")
        domain = F.regexp_extract(norm, "@(.*)$", 1)
        host = let(_stream(key, F.lit("domain"), domain, F.lit(0), F.lit(64)), lambda t: F.concat(
            _replaced(F.regexp_replace(F.regexp_extract(domain, r"^[^.]+", 0), "^.{0,3}$", "mail"), t), F.lit(".example."),
            F.regexp_extract(domain, r"([^.]+)$", 1)))
        longer = F.greatest(attempt - (LONGER_FROM - 1), F.lit(0))
        local = F.regexp_extract(F.when(attempt == 0, form).otherwise(F.concat(F.repeat(F.lit("a"), longer + 1), form)), "^(.*)@", 1)
        # places by the norm, as spellings differ in length
        more = F.when(kind.isin("ssn", "phone", "iban", "secret", "token", "private_key") & (longer > 0), F.array_join(F.transform(
            F.sequence(F.lit(1), longer), lambda j: (_byte(s, F.length(norm) + j - 1) % 10).cast("string")), "")).otherwise(F.lit(""))
        return F.concat(F.when(kind.isin("given_f", "given_m", "given", "family"), _name(form, s, kind, attempt))
                .when(kind == "email", F.concat(_replaced(local, s), F.lit("@"), host))
                .when(kind == "card", card).when(kind == "ssn", laid("0-9", F.lit(0)))
                .when(kind == "phone", laid("0-9+", lead)).when(kind == "ip4", octets)
                .when(kind == "ip6", _replaced_hex(form, s)).when(kind == "iban", laid("A-Z0-9", F.lit(2)))
                .otherwise(_replaced(form, s, F.when(form.rlike("^(?:AKIA|ASIA|gh[pousr]_)"), F.lit(4)).otherwise(F.lit(0)))), more)

    return let(_stream(key, kind, norm, attempt, F.length(form) + 32), made)


def _replaced_hex(form: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(c.rlike("[0-9A-Fa-f]"), F.substr(
        F.lit("0123456789abcdef"), _byte(stream, i) % 16 + 1, F.lit(1))).otherwise(c)), "")


def kind_of(entity: Column) -> Column:
    out = F.lit("person")
    for kind, pattern in reversed(PATTERNS[:-1]):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    # numbers that look like cards but fail the check digit are no personal data
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return let(out, lambda k: F.when((k == "card") & ((_luhn(digits) != 0) | (F.length(digits) < 13)), F.lit("none")).otherwise(k))


def pieces_of(kind: Column, entity: Column) -> Column:
    """Pieces of an entity in order: (kind, form); kind null for text that stays."""
    piece = lambda k, f: F.struct(k.cast("string").alias("kind"), f.alias("form"))
    stays = lambda f: piece(F.lit(None), f)
    head = F.regexp_extract(entity, r"^((?i:[a-z_-]+)['\"]?\s{0,3}[=:]\s{0,3}['\"]?)", 1)
    secret = F.array(stays(head), piece(kind, F.substr(entity, F.length(head) + 1, F.length(entity))))
    titled = F.regexp_extract(entity, rf"^((?:{_TITLE})\.? )", 1)
    names = F.substr(entity, F.length(titled) + 1, F.length(entity))
    title = F.regexp_extract(titled, r"^[^. ]+", 0)
    given = F.regexp_extract(names, r"^\S+(?= )", 0)
    gender = F.when(title.isin(*FEMALE_TITLES) | given.isin(*FEMALE), F.lit("given_f")).when(
        title.isin(*MALE_TITLES) | given.isin(*MALE), F.lit("given_m")).otherwise(F.lit("given"))
    person = F.filter(F.array(stays(titled), piece(gender, given), stays(F.when(given != "", " ").otherwise("")),
                              piece(F.lit("family"), F.regexp_extract(names, r"\S+$", 0))), lambda p: p["form"] != "")
    return F.when(kind == "secret", secret).when(kind == "person", person).when(
        kind == "none", F.array(stays(entity))).otherwise(F.array(piece(kind, entity)))


def assign(pieces: DataFrame, key: str) -> DataFrame:
    """``kind``, ``norm`` and the ``attempt`` whose surrogate is neither another piece's nor real data.

    All pieces start at attempt 0; in every round those whose surrogate is taken move on, of several with one
    surrogate all but the first in order. A handful of rounds settles all, for later attempts draw from more letters
    and those from ``LONGER_FROM`` on from a space that grows with each.
    """
    distinct = pieces.groupBy("kind", "norm").agg(F.min("form").alias("form"))
    made = lambda df: df.withColumn("made", normal_form(F.col("kind"), surrogate(
        key, F.col("kind"), F.col("form"), F.col("norm"), F.col("attempt"))))
    table = staged(made(distinct.withColumn("attempt", F.lit(0))), "pii-assigned")
    for _ in range(MOST_ATTEMPTS):
        real = table.select("kind", F.col("norm").alias("made"), F.lit(True).alias("_real"))
        first = Window.partitionBy("kind", "made").orderBy("norm")
        judged = table.withColumn("_n", F.row_number().over(first)).join(real, ["kind", "made"], "left")
        judged = judged.withColumn("_taken", (F.col("_n") > 1) | F.col("_real").isNotNull())
        moved = judged.where("_taken").count()
        if not moved:
            return table
        settled = judged.where(~F.col("_taken")).select("kind", "norm", "form", "attempt", "made")
        again = made(judged.where("_taken").select("kind", "norm", "form", (F.col("attempt") + 1).alias("attempt")))
        table = staged(settled.unionByName(again), "pii-assigned")
    raise ValueError("a kind of personal data has fewer surrogates than distinct values")


def replace_entities(docs: DataFrame, key: str = "surrogates-1", text_col: str = "text") -> DataFrame:
    """``docs`` with every entity replaced and two more columns, ``pii_count`` and ``pii_kinds`` (sorted, distinct).

    Whole texts of any length. Null and empty texts and texts without entities stay as they are with count 0; equal
    texts get equal results whatever their ids; an empty table gives no rows. Input columns named like the two added
    ones are overwritten.
    """
    columns = [c for c in docs.columns if c not in ("pii_count", "pii_kinds")]
    docs = docs.select(*[F.col(f"`{c}`") for c in columns])
    text = F.col(text_col).cast("string")
    # cheap signs first
    marked = F.coalesce((text.rlike(SIGNS) | text.rlike(PERSON)) & text.rlike(ANY), F.lit(False))
    clean = docs.where(~marked).withColumns({"pii_count": F.lit(0), "pii_kinds": F.array().cast("array<string>")})
    dirty = docs.where(marked).withColumn("_digest", F.sha2(text, 256))
    texts = dirty.groupBy("_digest").agg(F.first(text).alias("_text"))
    # each entity takes along the text before it, the last one also the text after it
    items = let(F.struct(F.split("_text", ANY, -1).alias("gaps"), F.regexp_extract_all("_text", F.lit(ANY), F.lit(0)).alias("all")),
                lambda x: F.transform(x["all"], lambda e, i: F.struct(
                    F.get(x["gaps"], i).alias("before"), e.alias("entity"),
                    F.when(i == F.size(x["gaps"]) - 2, F.get(x["gaps"], i + 1)).alias("after"))))
    found = texts.select("_digest", items.alias("_items")).select("_digest", F.posexplode("_items").alias("_at", "_item"))
    found = found.select("_digest", "_at", F.col("_item.before").alias("_before"), F.col("_item.after").alias("_after"),
                         F.col("_item.entity").alias("_entity"), kind_of(F.col("_item.entity")).alias("_kind"))
    parts = found.select("_digest", "_at", "_before", "_after", "_kind", F.posexplode(
        pieces_of(F.col("_kind"), F.col("_entity"))).alias("_part", "_piece"))
    parts = staged(parts.select("_digest", "_at", "_part", "_before", "_after", "_kind", F.col("_piece.kind").alias("kind"),
                                F.col("_piece.form").alias("form"), normal_form(
                                    F.col("_piece.kind"), F.col("_piece.form")).alias("norm")), "pii-parts")
    table = assign(parts.where("kind IS NOT NULL").select("kind", "norm", "form"), key)
    parts = parts.join(table.select("kind", "norm", "attempt"), ["kind", "norm"], "left")
    stand_in = F.when(F.col("kind").isNull(), F.col("form")).otherwise(
        surrogate(key, F.col("kind"), F.col("form"), F.col("norm"), F.coalesce(F.col("attempt"), F.lit(0))))
    piece = F.concat(F.when(F.col("_part") == 0, F.col("_before")).otherwise(F.lit("")), stand_in)
    parts = parts.select("_digest", F.struct("_at", "_part", piece.alias("s"), "_after", "_kind").alias("p"))
    rebuilt = parts.groupBy("_digest").agg(F.array_sort(F.collect_list("p")).alias("p")).select(
        "_digest", F.concat(F.array_join(F.transform("p", lambda x: x["s"]), ""),
                            F.element_at("p", -1)["_after"]).alias("_new"),
        F.size(F.array_distinct(F.transform(F.filter("p", lambda x: x["_kind"] != "none"), lambda x: x["_at"]))).alias("pii_count"),
        F.array_sort(F.array_distinct(F.transform(F.filter("p", lambda x: x["_kind"] != "none"), lambda x: x["_kind"]))).alias("pii_kinds"))
    replaced = dirty.join(rebuilt, "_digest").select(
        *[F.col("_new").alias(c) if c == text_col else F.col(f"`{c}`") for c in columns], "pii_count", "pii_kinds")
    return clean.unionByName(replaced)
