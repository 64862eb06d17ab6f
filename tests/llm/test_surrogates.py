import re

from conftest_llm import AWKWARD
from wattframe.llm import surrogates
from wattframe.llm.surrogates import with_surrogates

TEXT = (
    "Mail a.b@mail7.example.com or A.B@Mail7.example.com, c@mail7.example.com. Mr. John Smith met Mrs. Anna"
    " Smith; Mr. Smith called +1 (017) 555-7713. Card 4111 1111 1111 1111, 4111111111111111."
    ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" at 97.51.17.173, (487) 555-7209, 123-45-6789,'
    " GB29 NWBK 6016 1331 9268 19, г-жа Анна Петрова, 2001:0db8:85a3:0000:0000:8a2e:0370:7334. End."
)
FORM = re.compile(
    r"Mail (\S+@\S+\.example\.org) or (\S+@\S+), (\S+@\S+)\. Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); Mr\. (\w+) called"
    r" (\+1 \(\d{3}\) \d{3}-\d{4})\. Card (\d{4} \d{4} \d{4} \d{4}), (\d{16})\. token = \"([0-9a-f]{40})\" at"
    r" (\d+\.\d+\.\d+\.\d+), (\(\d{3}\) \d{3}-\d{4}), (\d{3}-\d{2}-\d{4}),"
    r" (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d{2}), г-жа ([А-Яа-яё]+) ([А-Яа-яё]+), ((?:[0-9a-f]{4}:){7}[0-9a-f]{4})\. End\."
)


def luhn(number):
    digits = [int(d) for d in number][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_kinds_formats_and_coreference(docs):
    found = {r.doc_id: r for r in with_surrogates(docs([(1, TEXT), (2, "so c@MAIL7.example.com")]), "k").collect()}
    got = FORM.fullmatch(found[1].text)
    assert got, found[1].text
    one, again, other, _, john, _, anna, smith, phone, card, plain, *_ = got.groups()
    assert one == again != other and one.split("@")[1] == other.split("@")[1]
    assert john == anna == smith
    assert card.replace(" ", "") == plain and luhn(plain)
    assert got[4] in surrogates.GIVEN["latin", "m"].split() and got[6] in surrogates.GIVEN["latin", "f"].split()
    assert got[17] in surrogates.GIVEN["cyrillic", "f"].split()
    assert found[2].text == f"so {other}"
    assert found[1].n_entities == 16
    for real in FORM.fullmatch(found[1].text).groups():
        assert real not in TEXT


def test_key_matters(docs):
    table = docs([(1, TEXT)])
    first, same, other = (with_surrogates(table, key).first().text for key in ("a", "a", "b"))
    assert first == same != other


def test_clashes_are_resolved(docs):
    """Surnames have few first tries: among many, some share one."""
    names = [f"{a}{b}{c}" for a in "BCDFGHKLMN" for b in ("ara", "elo", "imu", "osa", "uri") for c in "bcdfghklmnpqrstvwxyz"]
    rows = [(i, f"Mr. {name} wrote to Mr. {name}") for i, name in enumerate(names)]
    found = [r.text for r in with_surrogates(docs(rows), "k").collect()]
    assert all(re.fullmatch(r"Mr\. (\w+) wrote to Mr\. \1", text) for text in found)
    assert len(set(found)) == len(names) == 1000


def test_surrogate_is_no_real_entity(docs):
    first = with_surrogates(docs([(1, "Herr Maier")]), "k").first().text
    both = {r.doc_id: r.text for r in with_surrogates(docs([(1, "Herr Maier"), (2, first)]), "k").collect()}
    assert both[1] != first and both[2] != first and both[1] != both[2]


def test_clean_text_stays(docs):
    rows = [(1, "In 2024, 12 of 30 (40 %) came at 10:30; v1.2.3 and a - b, 1,000,000."), (2, "Mr and Mrs met.")]
    assert {(r.doc_id, r.text) for r in with_surrogates(docs(rows), "k").collect()} == set(rows)


def test_awkward_rows(awkward, nothing):
    found = with_surrogates(awkward, "k")
    assert found.columns == [*awkward.columns, "n_entities"]
    assert sorted((repr(r.doc_id), repr(r.text)) for r in found.collect()) == sorted(
        (repr(i), repr(t)) for i, t in AWKWARD
    )
    assert with_surrogates(nothing, "k").collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_secrets_without_a_digit_in_the_text(docs):
    """No other part of these texts leads to the search."""
    secrets = [
        ("dbpassword=", "hunterxy"),
        ("accesstoken: ", "abcdefgh"),
        ("clientsecret=", "qwertyui"),
        ("myapi_key = ", "zxcvbnma"),
        ("key ", "AKIA" + "QWERTYUIOPASDFGH"),
        ("key ", "ghp_" + "abcdefghijkl" * 3),
        ("key ", "abcdef" * 6),
        ("key ", "ABCDEF" * 6),
        ("éksk-", ""),
        ("ésk-", "abcdefghijklmnopqrstuvwxyz"),
        ("at ", "a:b:c:d:e:f:a:b"),
    ]
    rows = [(i, f"x {before}{secret} y") for i, (before, secret) in enumerate(secrets)]
    found = {r.doc_id: r for r in with_surrogates(docs(rows), "k").collect()}
    for i, (before, secret) in enumerate(secrets):
        assert found[i].n_entities == (1 if secret else 0)
        assert found[i].text.startswith("x ") and found[i].text.endswith(" y")
        assert not secret or secret not in found[i].text


def test_long_secrets_go_whole(docs):
    token = ".".join(["eyJhbGciOiJIUzI1NiJ9" * 30] * 3)
    lower, upper = "0123456789abcdef" * 40, "0123456789ABCDEF" * 40
    long_key, github = "sk-" + "Zz9" * 200, "ghp_" + "Zz9" * 200
    secrets = [f"token={token}", lower, upper, long_key, github]
    rows = [(i, f"x {secret} y") for i, secret in enumerate(secrets)]
    found = {r.doc_id: r for r in with_surrogates(docs(rows), "k").collect()}
    for i, secret in enumerate(secrets):
        put = found[i].text.removeprefix("x token=" if i == 0 else "x ").removesuffix(" y")
        real = secret.removeprefix("token=")
        assert found[i].n_entities == 1 and len(put) == len(real)
        assert not any(real[k : k + 24] in put for k in range(0, len(real) - 24, 24))
    assert re.fullmatch("[0-9a-f]{640}", found[1].text[2:-2]) and re.fullmatch("[0-9A-F]{640}", found[2].text[2:-2])


def test_form_fields_and_formats_that_are_used_up(docs):
    """Signs alone are no secret; all capitals in one place leave no free surrogate of the same length."""
    fields = ["password: ________", "token: ......", "token: ../../"]
    full = [f"token: _____{letter}" for letter in "GHIJKLMNOPQRSTUVWXYZABCDEF"]
    rows = list(enumerate(fields + full))
    found = {r.doc_id: r.text for r in with_surrogates(docs(rows), "k").collect()}
    assert [found[i] for i in range(3)] == fields
    puts = [found[i + 3] for i in range(26)]
    assert len(set(puts)) == 26 and not set(puts) & set(full)
    assert all(re.fullmatch(r"token: _____[A-Z]\d+", put) for put in puts)


def test_given_names_have_one_surrogate_whatever_the_title(docs):
    rows = [(1, "Dr. Anna Bell and Mrs. Anna Bell"), (2, "Dr. Chi Kern, Mr. Noah Kern, Mr. Robin Ott, Mrs. Robin Ott")]
    found = {r.doc_id: r.text for r in with_surrogates(docs(rows), "k").collect()}
    one, other = re.fullmatch(r"Dr\. (\w+ \w+) and Mrs\. (\w+ \w+)", found[1]).groups()
    assert one == other and one.split()[0] in surrogates.GIVEN["latin", "f"].split()
    luca, kern, noah, again, robin, ott, same, _ = re.findall(r"(?<!^)\b(?!Dr|Mrs?\b)\w+", found[2])
    assert luca in surrogates.GIVEN["latin", "x"].split() and noah in surrogates.GIVEN["latin", "m"].split()
    assert robin == same != luca and kern == again != ott


def test_names_alone_go_with_their_person(docs):
    rows = [
        (1, "Mr. John Smith came. Smith said that John left; SMITH'S car, Smith’s dog. Johnny and Smithson stay."),
        (2, "John and Smith are named without a title."),
        (3, "Miss You came. You know, when you and You meet."),
        (4, "Mr. JOHN Smith. John."),
    ]
    found = {r.doc_id: r for r in with_surrogates(docs(rows), "k").collect()}
    john, smith = re.match(r"Mr\. (\w+) (\w+) came", found[1].text).groups()
    assert found[1].text == (
        f"Mr. {john} {smith} came. {smith} said that {john} left; {smith.upper()}'S car, {smith}’s dog. Johnny and Smithson stay."
    )
    assert found[1].n_entities == 1 and found[2].text == rows[1][1]
    assert re.fullmatch(r"Miss \w+ came\. You know, when you and You meet\.", found[3].text)
    assert found[4].text == f"Mr. {john.upper()} {smith}. {john}."


def test_words_of_assignments_in_any_case_and_signs(docs):
    secrets = [("PASSWORD=", "hunterxy"), ("Token: ", "abcdefgh"), ("Pwd = ", "p@ss!w#rd"), ("API_KEY='", "Zm9vYmFy=="), ("tel ", "0171 1234567")]
    found = {r.doc_id: r for r in with_surrogates(docs([(i, f"x {b}{s} y") for i, (b, s) in enumerate(secrets)]), "k").collect()}
    for i, (before, secret) in enumerate(secrets):
        put = found[i].text.removeprefix(f"x {before}").removesuffix(" y")
        assert found[i].n_entities == 1 and secret not in put and len(put) == len(secret)


def test_numbers_without_a_card_s_check_digit_stay(docs):
    """Order numbers and book numbers, also next to a card; each candidate against the plain rule."""
    numbers = [f"{4_111_111_111_111_100 + i}" for i in range(40)] + ["978-3-16-148410-0", "5105105105105100", "9807915762804490"]
    rows = [(i, f"No. {number} and 4111 1111 1111 1111.") for i, number in enumerate(numbers)]
    found = {r.doc_id: r for r in with_surrogates(docs(rows), "k").collect()}
    for i, number in enumerate(numbers):
        digits = re.sub(r"\D", "", number)
        card = digits[0] in "23456" and luhn(digits)
        assert found[i].n_entities == 1 + card
        assert (number in found[i].text) != card and "4111 1111 1111 1111" not in found[i].text
