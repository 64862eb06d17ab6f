"""Replacing personal data by keyed surrogates of the same kind and form.

Everything is an expression over built-in functions. A pattern finds the entities of a text; each is
replaced by what a keyed hash of its canonical form makes in the same format, so an entity has the
same surrogate wherever and however it is written. The distinct entities of the corpus are checked
for surrogates that two of them share or that are real entities themselves; those get another salt
until none is left, so different entities stay different.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.session import keep

# Titles that carry a gender, given names and name syllables by script.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Господин", "г-н", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Signora",
          "Госпожа", "г-жа", "Κυρία"],
    "x": ["Dr", "Prof", "Professor", "Mx"],
}
GIVEN = {
    ("latin", "m"): "Albert Bruno Carl David Emil Felix Gustav Hugo Ivan Jonas Karl Leon Martin Noel Oscar Paul",
    ("latin", "f"): "Alma Berta Clara Dora Emma Flora Greta Helen Ida Julia Klara Laura Maria Nora Olga Paula",
    ("latin", "x"): "Alex Andrea Billie Casey Chris Dana Eden Florin Jules Kim Lou Luca Nico Robin Sam Toni",
    ("cyrillic", "m"): "Антон Борис Вадим Глеб Денис Егор Иван Кирилл Лев Макар Никита Олег Павел Роман Семён Юрий",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Кира Лидия Мария Нина Ольга Полина Раиса Юлия",
    ("cyrillic", "x"): "Саша Женя Валя Слава Тоня Паша Шура Миша Витя Лера Гера Юля Лёня Вася Никита Сима",
    ("greek", "m"): "Άγγελος Βασίλης Γιώργος Δημήτρης Ευάγγελος Ηλίας Θωμάς Ιάσων Κώστας Λουκάς Μάρκος Νίκος"
    " Ορέστης Πέτρος Στέφανος Χρήστος",
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ηλιάνα Θάλεια Ιωάννα Κατερίνα Λυδία Μαρία Νίκη"
    " Ολυμπία Σοφία Χριστίνα",
    ("greek", "x"): "Άρτεμις Φοίβη Αλέξης Χάρις Ρένα Νιόβη Δάφνη Ίρις Λητώ Μυρτώ Όλγα Πάρις Ρόη Τέσσα Φαίη Χλόη",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fi ga go ha ka ke ko la le li lo ma me mi mo na ne no pa ra re ro sa ta to".split(),
    "cyrillic": "ба бе бо ва ве да до за зо ка ке ко ла ле ли ло ма ме ми мо на не но па по ра ре ро са со та то".split(),
    "greek": "βα βε γα γο δα δε ζα θε κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε ρα ρε ρο σα σε σο τα το".split(),
}
_SCRIPT = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}
_ENDINGS = {"latin": ("r", "a"), "cyrillic": ("н", "а"), "greek": ("ς", "α")}

_WORD = r"\p{Lu}[\p{L}'’-]+"
_ALL_TITLES = sorted((t for titles in TITLES.values() for t in titles), key=lambda t: (-len(t), t))
_FIRST = "".join(sorted({title[0] for title in _ALL_TITLES}))
_TITLE = rf"(?=[{_FIRST}])(?:" + "|".join(_ALL_TITLES) + r")\.?"

#: Kinds in the order in which a place of a text is tried.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}"
    r"|sk-[0-9A-Za-z_-]{20,})(?![0-9A-Za-z])"
    r"|(?<=[=: \"'])(?<=(?:(?i)token|secret|password|passwd|pwd|api_key|apikey|api-key) {0,3}[=:] {0,3}[\"']{0,1})"
    r"(?=[_./+@!#$%^&*=-]*[0-9A-Za-z])[0-9A-Za-z_./+@!#$%^&*=-]{6,}",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "ipv6": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)[2-6](?:[ -]?\d){12,18}(?!\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|\d{3}[ .-]\d{3}[ .-]\d{4}|(?<![.,/-])0\d{2,4}[ /-]\d{6,8})(?!\d)",
    "person": rf"(?<![\p{{L}}\p{{N}}]){_TITLE} {_WORD}(?: {_WORD}){{0,2}}",
}
_ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
#: What every entity has, one of these words or a match of the pattern; most texts are done after this
#: one look. Letters alone can be an IPv6 address or a key. A title's first letter comes first: it rules
#: out most places of a text at once.
_HINT_WORDS = ["token", "secret", "passw", "pwd", "api", "sk-", "akia"]
_HINT = (
    r"[0-9@]|[A-Fa-f]:[A-Fa-f]|gh[pousr]_|[a-f]{32}|[A-F]{32}"
    rf"|(?=[{_FIRST}])(?<!\p{{L}}){_TITLE} \p{{Lu}}"
)

#: So many salts are tried in an entity's own format; from then on its surrogate grows with each salt.
FORMAT_SALTS = 6

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def entities(text: Column) -> Column:
    """All entities of a text in order, as they are written."""
    found = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    hint = reduce(or_, [F.lower(text).contains(word) for word in _HINT_WORDS]) | text.rlike(_HINT)
    return F.when(hint, found).otherwise(F.array().cast("array<string>"))


def kind_of(entity: Column) -> Column:
    """The kind of a match, NULL if it is none: a number in a card's format without its check digit."""
    kind = F.when(entity.rlike(f"^(?:{PATTERNS['person']})$"), "person").otherwise("secret")
    for name in reversed([k for k in PATTERNS if k not in ("person", "secret")]):
        kind = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    hexadecimal = entity.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$")
    digits = _digits(entity)
    valid = _check_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.right(digits, F.lit(1))
    return F.when(hexadecimal, "secret").when((kind != "card") | valid, kind)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def canonical(kind: Column, entity: Column) -> Column:
    """One form for all the ways to write an entity."""
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind.isin("ssn", "card", "phone"), _digits(entity))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .when(kind == "ipv6", F.lower(entity))
        .otherwise(entity)
    )


def _gender(person: Column) -> Column:
    title = F.regexp_extract(person, rf"^({_TITLE}) ", 1)
    bare = F.regexp_replace(title, r"\.$", "")
    return F.when(bare.isin(TITLES["m"]), "m").when(bare.isin(TITLES["f"]), "f").otherwise("x")


def _names(person: Column) -> Column:
    return F.split(F.regexp_replace(person, rf"^{_TITLE} ", ""), " ")


def _stream(key: str, kind: Column, form: Column, salt: Column) -> Column:
    """256 hexadecimal digits that only who knows the key can tell."""
    base = F.concat_ws("\x1f", F.lit(key), kind, form, salt.cast("string"))
    return F.concat(*[F.sha2(F.concat(base, F.lit(f"\x1f{i}")), 256) for i in range(4)])


def _number(stream: Column, i: Column) -> Column:
    """The stream's i-th byte."""
    return F.conv(F.substring(stream, (2 * i) % 256 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), number % len(letters) + 1, F.lit(1))


def _letters(stream: Column, count: int, start: int = 0) -> Column:
    places = F.sequence(F.lit(start), F.lit(start + count - 1))
    return F.array_join(F.transform(places, lambda i: _pick(_LOWER, _number(stream, i))), "")


def _in_format(entity: Column, put: Column) -> Column:
    """The digits ``put`` in the places of the entity's digits."""

    def at(i: Column) -> Column:
        sign = F.substring(entity, i, F.lit(1))
        count = F.length(_digits(F.substring(entity, F.lit(1), i)))
        return F.when(sign.rlike(r"\d"), F.substring(put, count, F.lit(1))).otherwise(sign)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), at), "")


def _like(entity: Column, stream: Column, keep_first: int = 0) -> Column:
    """Digits for digits, small letters for small and capital for capital; other signs stay."""

    def at(sign: Column, i: Column) -> Column:
        number = _number(stream, i + 1)
        return (
            F.when(i < keep_first, sign)
            .when(sign.rlike("[0-9]"), _pick(_DIGITS, number))
            .when(sign.rlike("[A-Z]"), _pick(_UPPER, number))
            .when(sign.rlike("[a-z]"), _pick(_LOWER, number))
            .otherwise(sign)
        )

    return F.array_join(F.transform(F.split(entity, ""), at), "")


def _stream_digits(stream: Column, count: Column) -> Column:
    places = F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)
    return F.substring(
        F.array_join(F.transform(places, lambda i: _pick(_DIGITS, _number(stream, i))), ""), F.lit(1), count
    )


def _check_digit(body: Column) -> Column:
    """The digit that makes a card number valid (Luhn)."""
    length = F.length(body)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(body, length - i, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(i % 2 == 0, F.when(double > 9, double - 9).otherwise(double)).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), length - 1), F.lit(0), add)
    return ((10 - total % 10) % 10).cast("string")


def _name(kind: Column, name: Column, stream: Column, salt: Column) -> Column:
    """A name of the same script and gender; with a salt a made-up one, longer with each salt."""
    script = F.lit("latin")
    for other, pattern in _SCRIPT.items():
        script = F.when(name.rlike(pattern), other).otherwise(script)
    out = F.lit(None).cast("string")
    for known, syllables in SYLLABLES.items():
        table = F.array(*[F.lit(s) for s in syllables])
        made = F.array_join(
            F.transform(
                F.sequence(F.lit(0), salt + 2), lambda i: F.element_at(table, _number(stream, i + 1) % len(syllables) + 1)
            ),
            "",
        )
        masculine, feminine = _ENDINGS[known]
        ending = F.when(kind == "given:f", feminine).when(kind == "given:m", masculine).otherwise("")
        own = F.initcap(F.concat(made, ending))
        for (pool_script, gender), pool in GIVEN.items():
            if pool_script == known:
                names = F.array(*[F.lit(n) for n in pool.split()])
                chosen = F.element_at(names, _number(stream, F.lit(0)) % len(pool.split()) + 1)
                own = F.when((kind == f"given:{gender}") & (salt == 0), chosen).otherwise(own)
        out = F.when(script == known, own).otherwise(out)
    return F.when((name == F.upper(name)) & (F.length(name) > 1), F.upper(out)).otherwise(out)


def _in_iban(written: Column, put: Column) -> Column:
    """``put`` with the blanks that the number was written with."""

    def at(i: Column) -> Column:
        count = F.length(F.replace(F.substring(written, F.lit(1), i), F.lit(" "), F.lit("")))
        return F.when(F.substring(written, i, F.lit(1)) == " ", " ").otherwise(F.substring(put, count, F.lit(1)))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(written)), at), "")


def _put(table: DataFrame, key: str, written: str) -> DataFrame:
    """``table`` (``kind, form, salt`` and a column ``written``) with ``put``, its surrogate.

    The canonical form and the salt choose it, the column ``written`` says in which format.
    """
    domain = F.regexp_extract("form", "@(.*)$", 1)
    streamed = keep(
        table.withColumns(
            {
                "stream": _stream(key, F.col("kind"), F.col("form"), F.col("salt")),
                "domain": _stream(key, F.lit("domain"), domain, F.lit(0)),
            }
        )
    )
    stream, kind, form, sign = (F.col(c) for c in ("stream", "kind", "form", written))
    count = F.length(form)
    digits = streamed.withColumn("body", _stream_digits(stream, count - 1))
    body = F.col("body")
    groups = [F.substring(stream, F.lit(4 * i + 1), F.lit(4)) for i in range(8)]
    repeated = F.repeat(stream, F.ceil(F.length(sign) / 256).cast("int"))
    hexadecimal = F.substring(repeated, F.lit(1), F.length(sign))
    secret = (
        F.when(sign.rlike("^[0-9a-f]+$"), hexadecimal)
        .when(sign.rlike("^[0-9A-F]+$"), F.upper(hexadecimal))
        .otherwise(_like(sign, stream))
    )
    by_kind = {
        "email": F.concat(_letters(stream, 10), F.lit("@"), _letters(F.col("domain"), 10), F.lit(".example.org")),
        "ipv4": F.concat_ws(".", F.lit("10"), *[_number(stream, F.lit(i)).cast("string") for i in range(3)]),
        "ipv6": F.concat(F.lit("fd"), F.substring(F.concat_ws(":", *groups), F.lit(3), F.lit(37))),
        "card": _in_format(sign, F.concat(body, _check_digit(body))),
        "ssn": _in_format(sign, _stream_digits(stream, count)),
        "phone": _in_format(sign, F.concat(F.substring(form, F.lit(1), F.lit(1)), body)),
        "iban": _in_iban(sign, _like(form, stream, keep_first=2)),
        "secret": secret,
    }
    # A format without a free surrogate gets a longer one; names grow by themselves.
    more = 4 * (F.col("salt") - FORMAT_SALTS)
    longer = {
        "ipv4": by_kind["ipv6"],
        **{name: F.concat(by_kind[name], _stream_digits(stream, more)) for name in ("card", "ssn", "phone", "iban", "secret")},
    }
    put = _name(kind, sign, stream, F.col("salt"))
    for name, made in by_kind.items():
        made = F.when(more > 0, longer[name]).otherwise(made) if name in longer else made
        put = F.when(kind == name, made).otherwise(put)
    return digits.withColumn("put", put).drop("stream", "domain", "body")


def _family(kind: str) -> Column:
    """Given names of any gender are told apart from each other."""
    return F.substring_index(F.col(kind), ":", 1)


def _clashing(found: DataFrame, key: str) -> DataFrame:
    """Parts of ``found`` (``kind, form, salt``) that need another salt."""
    made = _put(found, key, "form")
    made = made.withColumn("put", F.lower(canonical(F.col("kind"), F.col("put"))))
    made = keep(made.withColumn("family", _family("kind")))
    groups = made.groupBy("family", "put").agg(
        F.min(F.struct("salt", "form")).alias("first"), F.count("*").alias("members")
    )
    shared = made.join(groups.where("members > 1"), ["family", "put"]).where(
        (F.col("salt") != F.col("first.salt")) | (F.col("form") != F.col("first.form"))
    )
    real = found.select(_family("kind").alias("family"), F.lower("form").alias("put")).distinct()
    taken = made.join(real, ["family", "put"], "left_semi")
    return shared.select("kind", "form").unionByName(taken.select("kind", "form")).distinct()


def salts(found: DataFrame, key: str) -> DataFrame:
    """``kind, form, salt`` of the parts that the first try does not serve; mostly none.

    ``found`` has the distinct parts of the corpus. Each round gives what still clashes another salt.
    It ends, as surrogates get longer after ``FORMAT_SALTS``.
    """
    tried = keep(found.select("kind", "form", F.lit(0).alias("salt")))
    while True:
        clashing = keep(_clashing(tried, key))
        if clashing.isEmpty():
            return tried.where("salt > 0")
        again = clashing.withColumn("more", F.lit(1))
        tried = keep(
            tried.join(again, ["kind", "form"], "left").select(
                "kind", "form", (F.col("salt") + F.coalesce("more", F.lit(0))).alias("salt")
            )
        )


def surrogates_of(entities_: DataFrame, key: str) -> DataFrame:
    """``written, put, names`` for each distinct entity as it is written; other matches have no row.

    A person's names are replaced one by one, so that somebody named in full once and by surname
    later stays one person; anything else is replaced as a whole. A given name is one for the whole
    corpus: its gender is that of the titles it stands with anywhere, and none if they differ or say
    nothing. ``names`` has a person's names in small letters with their surrogates.
    """
    kinds = keep(entities_.select("written", kind_of(F.col("written")).alias("kind")).where("kind IS NOT NULL"))
    whole = kinds.where("kind != 'person'").select(
        "written",
        F.lit(0).alias("at"),
        "kind",
        canonical(F.col("kind"), F.col("written")).alias("form"),
        F.col("written").alias("name"),
        F.lit("").alias("title"),
    )
    written = F.col("written")
    people = keep(
        kinds.where("kind = 'person'")
        .select(
            "written",
            F.regexp_extract(written, rf"^({_TITLE} )", 1).alias("title"),
            _gender(written).alias("gender"),
            F.size(_names(written)).alias("names"),
            F.posexplode(_names(written)).alias("at", "name"),
        )
        .withColumn("form", F.lower("name"))
    )
    given = F.col("at") < F.col("names") - 1
    said = people.where(given).groupBy("form").agg(
        F.bool_or(F.col("gender") == "m").alias("m"), F.bool_or(F.col("gender") == "f").alias("f")
    )
    one = F.when(F.col("m") & ~F.col("f"), "given:m").when(F.col("f") & ~F.col("m"), "given:f").otherwise("given:x")
    named = people.join(said.select("form", one.alias("role")), "form", "left")
    people = named.select(
        "written", "at", F.when(given, F.col("role")).otherwise("surname").alias("kind"), "form", "name", "title"
    )
    parts = keep(whole.unionByName(people))
    salted = keep(salts(parts.select("kind", "form").distinct(), key))
    chosen = parts.join(salted, ["kind", "form"], "left").withColumn("salt", F.coalesce("salt", F.lit(0)))
    made = _put(chosen, key, "name")
    of_person = (F.col("kind") == "surname") | F.col("kind").startswith("given:")
    return (
        made.groupBy("written")
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "put"))).alias("parts"),
            F.first("title").alias("title"),
            F.collect_list(F.when(of_person, F.struct("form", "put"))).alias("names"),
        )
        .select("written", F.concat("title", F.array_join("parts.put", " ")).alias("put"), "names")
    )


def _names_of_texts(puts: DataFrame) -> DataFrame:
    """``check, names``: per text the names of its persons that may also stand alone, with surrogates.

    A name that is written in two roles has the surrogate of its first place.
    """
    each = puts.where(F.size("names") > 0).select("check", "at", F.explode("names").alias("name"))
    first = each.groupBy("check", "name.form").agg(F.min_by("name.put", F.struct("at", "name.put")).alias("put"))
    entries = F.collect_list(F.struct("form", F.initcap("put").alias("put")))
    return first.groupBy("check").agg(F.map_from_entries(entries).alias("names"))


def _names_replaced(piece: Column, names: Column) -> Column:
    """``piece`` with the capitalised words that are one of ``names``, also before ``'s``, replaced."""

    def put(word: Column) -> Column:
        end = F.regexp_extract(word, "['’][sS]?$", 0)
        stem = F.left(word, F.length(word) - F.length(end))
        known = F.element_at(names, F.lower(word))
        by_stem = F.concat(F.element_at(names, F.lower(stem)), end)
        new = F.coalesce(known, by_stem)
        capital = (F.length(stem) > 1) & (stem == F.upper(stem))
        return F.when(word.rlike(r"^\p{Lu}"), F.coalesce(F.when(capital, F.upper(new)).otherwise(new), word)).otherwise(word)

    words = F.regexp_extract_all(piece, F.lit(r"[\p{L}\p{N}'’-]+|[^\p{L}\p{N}'’-]+"), F.lit(0))
    return F.array_join(F.transform(words, put), "")


def with_surrogates(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs``, personal data in the text replaced, and ``n_entities``.

    Equal entities get equal surrogates in all documents, different ones different surrogates, and no
    surrogate is an entity of the corpus. The names of a text's persons are replaced wherever they stand
    alone in that text too, with a capital, unless the text also has the word in small letters;
    ``n_entities`` does not count these places. Numbers in a card's format stay if their check digit is wrong.

    NULL text stays NULL with 0 entities, empty text empty; very
    long texts are read whole. Rows that repeat an identifier are treated each by its text. Other
    columns pass unchanged whatever their names (but ``n_entities`` is replaced); no rows in, no rows
    out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Written, so that each text is searched once.
    marked = keep(docs.withColumns({"__check": F.sha2(text, 256), "__entities": entities(text)}))
    several = F.size("__entities") > 0
    listed = keep(
        marked.where(several)
        .select(F.col("__check").alias("check"), F.col("__entities").alias("entities"))
        .dropDuplicates(["check"])
    )
    dictionary = keep(surrogates_of(listed.select(F.explode("entities").alias("written")).distinct(), key))
    found = keep(
        listed.select("check", F.posexplode("entities").alias("at", "written")).join(dictionary, "written", "left")
    )
    puts = found.groupBy("check").agg(
        F.array_sort(F.collect_list(F.struct("at", F.coalesce("put", "written").alias("put")))).alias("puts"),
        F.count("put").alias("count"),
    )
    # Written, so that both sides of the join have an exchange and a frequent text can be split.
    puts = keep(
        puts.join(_names_of_texts(found), "check", "left").select(
            F.col("check").alias("__check"), F.col("puts.put").alias("__puts"),
            F.col("count").alias("__count"), F.col("names").alias("__names"),
        )
    )
    small = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<!\p{L})\p{Ll}[\p{L}'’-]*"), F.lit(0)))
    alone = F.array_except(F.map_keys("__names"), small)
    names = F.map_filter("__names", lambda name, _: F.array_contains("__alone", name))
    pieces = F.split(text, _ANY, -1)

    def whole(piece_of) -> Column:
        return F.array_join(
            F.transform(pieces, lambda piece, i: F.concat(piece_of(piece), F.coalesce(F.get("__puts", i), F.lit("")))), ""
        )

    def columns(new_text: Column, count: Column) -> list[Column]:
        kept = [name for name in docs.columns if name != "n_entities"]
        return [
            *[new_text.alias(name) if name == text_col else F.col(f"`{name}`") for name in kept],
            count.cast("long").alias("n_entities"),
        ]

    # Only texts with entities are moved.
    moved = marked.where(several).join(puts, "__check").withColumn("__alone", alone).withColumn("__names", names)
    new_text = F.when(
        F.size("__alone") > 0, whole(lambda piece: _names_replaced(piece, F.col("__names")))
    ).otherwise(whole(lambda piece: piece))
    replaced = moved.select(*columns(new_text, F.col("__count")))
    return marked.where(~several).select(*columns(F.col(text_col), F.lit(0))).unionByName(replaced)
