"""Surrogates for personal data: keyed, of the same kind, never two for one.

Entities are found by pattern. Each distinct entity gets a replacement drawn
from SHA-256 of (secret key, kind, canonical form, attempt, place):

    email      letters and digits anew, separators and top domain kept
    ip         four octets of 0 to 255, the first from 1 to 222
    phone      country code and punctuation kept, digits anew
    card       length, grouping, issuer digit and Luhn validity kept
    ssn, iban  format kept, digits and letters anew
    secret     key prefixes and field names kept, the rest anew by class; a value
               with fewer than LEAST_FRESH letters and digits gets more
    name       title kept; each given name from a list of its gender and script,
               family name from syllables of its script, both word by word

Letters keep case and script (Latin, Greek, Cyrillic). The same canonical
form gets the same replacement in every document; a name has none of its own,
but each of its words has, so a person's titles, and a family name with or
without a given name, agree. Replacements that meet each other, or any entity
of the corpus, are drawn again with the next attempt until none do. Emails,
secrets behind a field name and the words of names grow by a character or a
syllable with each attempt, so that a free one exists. Everything is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import bind, materialize

# fixed patterns of the kinds
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# lengths as mail and host names have them at most: every search ends, whatever the text
LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
EMAIL = rf"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,252}}+@{LABEL}(?:\.{LABEL}){{0,125}}\.[A-Za-z]{{2,63}}"
IP = rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
CARD = r"(?<!\d)(?:\d{4}[ -]){3}\d{1,4}(?!\d)|(?<!\d)\d{13,16}(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?:password|passwd|secret|token|api_key)=[^\s\"']+|(?<![A-Za-z0-9])[0-9a-f]{40}(?![A-Za-z0-9])"
TITLES_M = r"Mr\.?|Herr|Señor|Sr\.|Monsieur|Господин|Κύριος"
TITLES_F = r"Mrs\.?|Ms\.?|Miss|Frau|Señora|Sra\.|Madame|Mme|Госпожа|Κυρία"
NAME_WORD = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
NAME = rf"(?<!\p{{L}})(?:{TITLES_M}|{TITLES_F}) {NAME_WORD}(?: {NAME_WORD}){{0,2}}(?!\p{{L}})"
KINDS = (
    ("email", EMAIL),
    ("card", CARD),
    ("ssn", SSN),
    ("phone", PHONE),
    ("ip", IP),
    ("secret", SECRET),
    ("iban", IBAN),
    ("name", NAME),
)
ANY = "|".join(f"(?:{p})" for _, p in KINDS)

#: Letters and digits that a secret's value has anew at least.
LEAST_FRESH = 4
#: Kinds of the words of names; given names by gender.
NAME_PARTS = ("given_m", "given_f", "family")

#: What a text with an entity must have: one of these pieces, or a match of NEEDED.
PIECES = [
    "@",
    *["AKIA", "ASIA", "password=", "passwd=", "secret=", "token=", "api_key="],
    *[
        f"{title}{end} "
        for titles in (TITLES_M, TITLES_F)
        for t in titles.split("|")
        for title, ends in [(t.removesuffix(r"\.?").replace(r"\.", "."), ("", ".") if t.endswith("?") else ("",))]
        for end in ends
    ],
]
#: Two digits around a mark (card, SSN, phone, IP), long digits, +1, IBAN, hex keys.
NEEDED = r"\d[ .-]\d|\d\) ?\d|\d{13}|\+\d|[A-Z]\d\d|[0-9a-f]{40}"

# given names by gender and script, and syllables of family names
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl Daniel Erik Felix Hugo Ivan Jonas Karl Leo Martin Nils Oscar Paul Robert",
    ("f", "latin"): "Alma Berta Clara Diana Emma Flora Greta Hanna Irene Julia Karla Laura Maria Nora Olga Rosa",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Егор Иван Кирилл Лев Максим Павел",
    ("f", "cyrillic"): "Алла Вера Дарья Елена Жанна Инна Лидия Мария Нина Ольга",
    ("m", "greek"): "Αλέξης Βασίλης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Σπύρος",
    ("f", "greek"): "Άννα Βάσω Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve",
    "cyrillic": "ба бо ва во га го да до за ка ко ла ло ма мо на но па по ра ро са со та то",
    "greek": "βα βο γα γο δα δο κα κο λα λο μα μο να νο πα πο ρα ρο σα σο τα το",
}


def may_hold(text: Column) -> Column:
    """False only for texts without any entity; far cheaper than the patterns."""
    out = F.lit(False)
    for piece in PIECES:
        out = out | F.contains(text, F.lit(piece))
    return F.coalesce(out | text.rlike(NEEDED), F.lit(False))


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern is the whole entity."""
    out = F.when(entity.rlike(f"^(?:{KINDS[0][1]})$"), KINDS[0][0])
    for kind, pattern in KINDS[1:]:
        out = out.when(entity.rlike(f"^(?:{pattern})$"), kind)
    return out


def canonical(kind: Column, entity: Column) -> Column:
    """What makes two spellings one entity: digits, or letters in lower case."""
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind.isin("email", "name"), F.lower(entity))
        .otherwise(entity)
    )


def name_parts(entity: Column) -> Column:
    """Array of (kind, canon) of the words of a name behind its title."""
    women = entity.rlike(f"^(?:{TITLES_F}) ")
    words = F.split(F.lower(entity), " ")
    return F.transform(
        F.slice(words, F.lit(2), F.size(words) - 1),
        lambda w, i: F.struct(
            F.when(i == F.size(words) - 2, "family")
            .when(women, "given_f")
            .otherwise("given_m")
            .alias("kind"),
            w.alias("canon"),
        ),
    )


# -- drawing ----------------------------------------------------------------


def draws(key: str, kind: Column, canon: Column, attempt: Column, n: Column) -> Column:
    """``n`` numbers below 65536 (16 a digest), fixed by the arguments."""
    digests = F.transform(
        F.sequence(F.lit(0), F.floor(n / 16).cast("int")),
        lambda i: F.sha2(
            F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), i.cast("string")),
            256,
        ),
    )
    return bind(
        F.array_join(digests, ""),
        lambda hexes: F.transform(
            F.sequence(F.lit(0), n),
            lambda i: F.conv(F.substring(hexes, i * 4 + F.lit(1), F.lit(4)), 16, 10).cast("int"),
        ),
    )


def letter(first: str, n: int, draw: Column) -> Column:
    letters = "".join(chr(ord(first) + i) for i in range(n))
    return F.substring(F.lit(letters), draw % n + 1, F.lit(1))


#: Characters that are drawn anew by class.
CLASSED = "0-9a-zß-öø-ÿA-ZÀ-ÖØ-Þа-яА-Яα-ρσ-ωΑ-ΡΣ-Ω"


def same_class(c: Column, draw: Column, hexes: bool = False) -> Column:
    """A character of the class, case and script of ``c``; marks stay."""
    out = F.when(c.rlike(r"^\d$"), (draw % 10).cast("string"))
    if hexes:
        out = out.when(c.rlike("^[a-f]$"), letter("a", 6, draw))
    return (
        out.when(c.rlike("^[a-zß-öø-ÿ]$"), letter("a", 26, draw))
        .when(c.rlike("^[A-ZÀ-ÖØ-Þ]$"), letter("A", 26, draw))
        .when(c.rlike("^[а-я]$"), letter("а", 32, draw))
        .when(c.rlike("^[А-Я]$"), letter("А", 32, draw))
        .when(c.rlike("^[α-ρσ-ω]$"), letter("σ", 7, draw))
        .when(c.rlike("^[Α-ΡΣ-Ω]$"), letter("Σ", 7, draw))
        .otherwise(c)
    )


def redrawn(text: Column, d: Column, keep: Column | None = None, hexes: bool = False) -> Column:
    """Each character drawn anew but the first ``keep`` ones."""
    chars = F.split(text, "")
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: same_class(c, F.get(d, i), hexes)
            if keep is None
            else F.when(i < keep, c).otherwise(same_class(c, F.get(d, i), hexes)),
        ),
        "",
    )


def luhn_sum(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    return (
        F.aggregate(
            F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i"))),
            F.lit(0),
            lambda s, x: s
            + F.when(x["i"] % 2 == 0, x["d"])
            .when(x["d"] * 2 > 9, x["d"] * 2 - 9)
            .otherwise(x["d"] * 2),
        )
        % 10
    )


def card(canon: Column, d: Column) -> Column:
    """New digits behind the issuer digit with the same Luhn remainder."""
    body = redrawn(F.expr("left(canon, length(canon) - 1)"), d, F.lit(1))
    return bind(
        body,
        lambda b: F.concat(
            b,
            F.pmod(luhn_sum(canon) - luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string"),
        ),
    )


def poured(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits and letters replaced in turn by ``digits``."""
    return F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike("[A-Za-z0-9]"),
            F.struct(
                F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out"),
                (s["at"] + 1).alias("at"),
            ),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )


def fresh(d: Column, first: Column, n: Column) -> Column:
    """``n`` letters and digits, from the draws behind ``first``."""
    marks = "0123456789abcdefghijklmnopqrstuvwxyz"
    each = F.transform(
        F.slice(d, first + 1, n), lambda x: F.substring(F.lit(marks), x % len(marks) + 1, F.lit(1))
    )
    return F.array_join(each, "")


def secret_value(value: Column, d: Column, attempt: Column) -> Column:
    """A field's value anew, with LEAST_FRESH fresh characters and one more for each attempt.

    Letters and digits of other classes become Latin letters; marks stay.
    """
    classed = F.regexp_replace(value, rf"[\p{{L}}\p{{N}}&&[^{CLASSED}]]", "x")
    free = F.length(F.regexp_replace(classed, f"[^{CLASSED}]", ""))
    more = F.greatest(F.lit(0), F.lit(LEAST_FRESH) - free) + attempt
    return F.concat(redrawn(classed, d), fresh(d, F.length(value), more))


def name_part(kind: Column, canon: Column, d: Column, attempt: Column) -> Column:
    """A given name of the kind's gender, or a family name, in lower case."""
    script = F.when(canon.rlike(r"[а-я]"), "cyrillic").when(canon.rlike(r"[α-ω]"), "greek").otherwise("latin")

    def pick(options: str, draw: Column) -> Column:
        names = options.lower().split()
        return F.get(F.array(*map(F.lit, names)), draw % len(names))

    out = F.lit(None).cast("string")
    for s, syllables in SYLLABLES.items():
        more = F.array_join(
            F.transform(F.slice(d, F.lit(6), attempt), lambda x: pick(syllables, x)), ""  # noqa: B023
        )
        family = F.concat(*[pick(syllables, F.get(d, j)) for j in range(1, 5)])
        given = F.when(kind == "given_f", pick(GIVEN["f", s], F.get(d, 0))).otherwise(
            pick(GIVEN["m", s], F.get(d, 0))
        )
        out = F.when(
            script == s, F.concat(F.when(kind == "family", family).otherwise(given), more)
        ).otherwise(out)
    return out


def drawn(kind: Column, canon: Column, d: Column, attempt: Column) -> Column:
    """The canonical form of the replacement."""
    top = F.length(F.regexp_extract(canon, r"\.[a-z]+$", 0))
    body = F.expr("left(canon, length(canon) - length(regexp_extract(canon, '\\\\.[a-z]+$', 0)))")
    octets = F.concat_ws(
        ".",
        (F.get(d, 0) % 222 + 1).cast("string"),
        *[(F.get(d, j) % 256).cast("string") for j in (1, 2, 3)],
    )
    field = F.regexp_extract(canon, "^[a-z_]+=", 0)
    value = F.substring(canon, F.length(field) + 1, F.length(canon))
    key_id = canon.rlike("^(?:AKIA|ASIA)")
    grown = fresh(d, F.length(canon), attempt)
    return (
        F.when(kind == "email", F.concat(redrawn(body, d), grown, F.substring(canon, -top, top)))
        .when(kind == "card", card(canon, d))
        .when(kind == "ip", octets)
        .when(kind == "iban", redrawn(canon, d, F.lit(2)))
        .when(kind == "phone", F.concat(redrawn(canon, d)))
        .when((kind == "secret") & key_id, redrawn(canon, d, F.lit(4)))
        .when((kind == "secret") & (field == ""), redrawn(canon, d, hexes=True))
        .when(kind == "secret", F.concat(field, secret_value(value, d, attempt)))
        .when(kind.isin(*NAME_PARTS), name_part(kind, canon, d, attempt))
        .otherwise(redrawn(canon, d))
    )


def dressed(kind: Column, entity: Column, new: Column) -> Column:
    """The replacement in the spelling of ``entity``: its marks, its case."""
    code = F.regexp_extract(entity, r"^\+\d{1,3}(?=[ .(-])", 0)
    cased = F.array_join(
        F.transform(
            F.split(new, ""),
            lambda c, i: F.when(
                F.substring(entity, i + 1, F.lit(1)).rlike(r"^\p{Lu}$"), F.upper(c)
            ).otherwise(c),
        ),
        "",
    )
    return (
        F.when(
            kind == "phone",
            F.concat(
                code,
                poured(
                    F.substring(entity, F.length(code) + 1, F.length(entity)),
                    F.substring(new, F.length(F.regexp_replace(code, r"\D", "")) + 1, F.length(new)),
                ),
            ),
        )
        .when(kind.isin("card", "ssn", "iban"), poured(entity, new))
        .when(kind == "email", cased)
        .when(kind == "name", F.concat_ws(" ", F.get(F.split(entity, " "), 0), F.initcap(new)))
        .otherwise(new)
    )


# -- jobs -------------------------------------------------------------------


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, new) for distinct (kind, canon), new distinct and unused.

    A draw that two entities share goes to the smaller one; a draw that is
    itself an entity goes to none, nor does a word of any name to a word of
    names. The others draw again until all are apart.
    """
    found = materialize(entities.select("kind", "canon").distinct(), "pii-entities")

    def draw(rows: DataFrame) -> DataFrame:
        n = F.length("canon") + 8 + F.col("attempt")
        d = draws(key, F.col("kind"), F.col("canon"), F.col("attempt"), n)
        return rows.withColumn("_d", F.array(d)).withColumn(
            "new", F.transform("_d", lambda x: drawn(F.col("kind"), F.col("canon"), x, F.col("attempt")))[0]
        ).drop("_d")

    table = materialize(draw(found.withColumn("attempt", F.lit(0))), "pii-drawn")
    while True:
        shared = (
            table.groupBy("kind", "new")
            .agg(F.min("canon").alias("owner"), F.count(F.lit(1)).alias("n"))
            .where("n > 1")
        )
        barred = F.when(
            F.col("kind").isin(*NAME_PARTS), F.array(*map(F.lit, NAME_PARTS))
        ).otherwise(F.array("kind"))
        used = (
            found.select(F.explode(barred).alias("kind"), F.col("canon").alias("new"))
            .distinct()
            .withColumn("used", F.lit(True))
        )
        judged = materialize(
            table.join(shared, ["kind", "new"], "left").join(used, ["kind", "new"], "left"),
            "pii-judged",
        )
        again = F.coalesce(F.col("used"), F.lit(False)) | F.coalesce(
            F.col("owner") != F.col("canon"), F.lit(False)
        )
        retry = judged.where(again).select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if retry.isEmpty():
            return table.select("kind", "canon", "new")
        held = judged.where(~again).select("kind", "canon", "attempt", "new")
        table = materialize(held.unionByName(draw(retry)), "pii-drawn")


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, n_replaced, kinds of every row, entities replaced.

    Null text stays null, a text without entities stays as it is, a null doc_id is
    as good as any: rows find their replacements by (doc_id, text hash), and
    rows alike in both get the same text. ``kinds`` lists the kinds found, in
    order. An empty table gives no row; other columns are not read.
    """
    doc = F.struct(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        doc.alias("doc"),
    )
    # searched once: a filter on what is found would search again
    searched = materialize(
        read.where(may_hold(F.col("text"))).withColumn(
            "found", F.regexp_extract_all("text", F.lit(ANY), 0)
        ),
        "pii-searched",
    )
    hits = searched.where(F.size("found") > 0)
    occurrences = (
        hits.select("doc", F.explode(F.array_distinct("found")).alias("entity"))
        .withColumn("kind", kind_of(F.col("entity")))
        .withColumn("canon", canonical(F.col("kind"), F.col("entity")))
    )
    occurrences = materialize(occurrences, "pii-occurrences")
    names = materialize(
        occurrences.where("kind = 'name'")
        .select("entity")
        .distinct()
        .select("entity", F.posexplode(name_parts(F.col("entity"))).alias("at", "part"))
        .select("entity", "at", "part.kind", "part.canon"),
        "pii-names",
    )
    others = occurrences.where("kind <> 'name'")
    table = surrogate_table(
        others.select("kind", "canon").union(names.select("kind", "canon")), key
    )
    whole = (
        names.join(table, ["kind", "canon"])
        .groupBy("entity")
        .agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("words"))
        .select("entity", F.array_join(F.col("words.new"), " ").alias("new"))
    )
    found = others.join(table, ["kind", "canon"]).select("doc", "kind", "entity", "new")
    named = (
        found.unionByName(
            occurrences.where("kind = 'name'")
            .join(whole, "entity")
            .select("doc", "kind", "entity", "new")
        )
        .withColumn("new", dressed(F.col("kind"), F.col("entity"), F.col("new")))
        .select("doc", "kind", F.struct("entity", "new").alias("pair"))
        .distinct()
    )
    by_doc = materialize(
        named.groupBy("doc").agg(
            F.map_from_entries(F.collect_list("pair")).alias("map"),
            F.sort_array(F.collect_set("kind")).alias("kinds"),
        ),
        "pii-maps",
    )
    between = F.split("text", ANY, -1)
    replaced = bind(
        between,
        lambda parts: F.array_join(
            F.transform(
                parts,
                lambda p, i: F.concat(
                    p, F.coalesce(F.element_at(F.col("map"), F.get(F.col("found"), i)), F.lit(""))
                ),
            ),
            "",
        ),
    )
    changed = hits.join(by_doc, "doc").select(
        "doc_id", replaced.alias("text"), F.size("found").alias("n_replaced"), "kinds"
    )
    rest = read.where(~may_hold(F.col("text"))).unionByName(
        searched.where(F.size("found") == 0).drop("found")
    )
    same = rest.select(
        "doc_id", "text", F.lit(0).alias("n_replaced"), F.array().cast("array<string>").alias("kinds")
    )
    return same.unionByName(changed)
