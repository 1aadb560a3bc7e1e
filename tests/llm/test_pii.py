import re
from itertools import product

import pytest

from heldout import CLEAN, LABELLED
from tallyloom.llm import pii

CASES = {
    "email": [
        ("write to jo.doe+x@a-b.example.org.", "jo.doe+x@a-b.example.org"),
        ("Complaints: <JO@NET.TEST>", "JO@NET.TEST"),
        ("|mail=jo_12 [at] post [dot] test}}", "jo_12 [at] post [dot] test"),
        ("jo(at)net.test", "jo(at)net.test"),
        ("Regards jo at net dot co dot test", "jo at net dot co dot test"),
    ],
    "phone": [
        ("Text me +1 (303) 555-0102", "+1 (303) 555-0102"),
        ("fax (303) 555-0102 (attn.", "(303) 555-0102"),
        ("|phone=212.555.0162|", "212.555.0162"),
        ("call 1-617-555-0182 now", "1-617-555-0182"),
        ("|| +44 (0)7700 900 105 ||", "+44 (0)7700 900 105"),
        ("ring 07700 900018; 5", "07700 900018"),
        ("ruft (030) 23125 304 an", "(030) 23125 304"),
        ("Tel. 030/23125-312", "030/23125-312"),
        ("tél. 01.99.00.43.08", "01.99.00.43.08"),
        ("tel. +34 900 55 04 87", "+34 900 55 04 87"),
        ("llama al 900-550-143 jajaja", "900-550-143"),
    ],
    "id_number": [
        ("passport no. XH4912994 into", "XH4912994"),
        ("the passport number E 40771030 is", "E 40771030"),
        ("NI number QY 41 30 36 C into", "QY 41 30 36 C"),
        ("SSN: 914-19-0901, issued", "914-19-0901"),
        ("ID card 956.443.917-05 on", "956.443.917-05"),
        ("DNI 32251708-Y.", "32251708-Y"),
        ("n° de sécurité sociale 3 77 43 46 851 389.", "3 77 43 46 851 389"),
        ("Steuer-ID 47 164 863 621;", "47 164 863 621"),
        ("Ausweisnummer: R81CY1579.", "R81CY1579"),
        ("pay GB82 WEST 1234 5698 7654 32 now", "GB82 WEST 1234 5698 7654 32"),
        ("card 4111 1111 1111 1111 ok", "4111 1111 1111 1111"),
    ],
    "street_address": [
        ("printed at 214 North Maple Street.", "214 North Maple Street"),
        ("at 66a Walnut Ct, 7 Hill Rd", "7 Hill Rd"),
        ("Foto, An der Kirschmühle 226", "An der Kirschmühle 226"),
        ("wohnt Birkenallee 78a;", "Birkenallee 78a"),
        ("in der Gartenstr. 48", "Gartenstr. 48"),
        ("habite 206b, chemin du Grand-Pré, x", "206b, chemin du Grand-Pré"),
        ("Contact, 54 allée du Vieux-Moulin, tél", "54 allée du Vieux-Moulin"),
        ("vive en C/ de los Plateros, 208, tel", "C/ de los Plateros, 208"),
        ("Camino del Roble Alto 69; DNI", "Camino del Roble Alto 69"),
    ],
    "person_name": [
        ("Contact: Frank S. Harper; x", "Frank S. Harper"),
        ("kept by Mrs Edith Bennett at", "Edith Bennett"),
        ("Frau Keller, Linda wohnt", "Keller, Linda"),
        ("La señora C. Romero vive en", "C. Romero"),
        ("M. Pierre Martin-Petit habite", "Pierre Martin-Petit"),
        ("checked by Ursula Keller and Olsen, Piet on site.", "Olsen, Piet"),
        ("this page is WRONG call PETER DUNN on (303) 555-0152", "PETER DUNN"),
        ("Foto: Frank Moran, Camino Monte Claro, 16", "Frank Moran"),
        ("| Ondrej Novak || +16175550127 ||", "Ondrej Novak"),
    ],
}


@pytest.mark.parametrize(("kind", "text", "value"), [(k, t, v) for k, cases in CASES.items() for t, v in cases])
def test_found(kind, text, value):
    assert (kind, value) in [(s.kind, text[s.start : s.end]) for s in pii.spans(text)]


@pytest.mark.parametrize(
    "text",
    [
        "ping @plan_keeper and @750bot", "79 tiles @ 599 each", "The motto reads ''at dawn dot by dot''.", "ISBN 978-120-43897-19-5", "Inventory no. 871-91-7703",
        "Shelfmark X70737766, sheet 539-9465", "grid ref. 2773 2363", "Population (census): 944 764 123", "oldid=155641831&diff=51227876", "Order 792241-9302 of the harbour board",
        "Walk 20, Lane 8, Court 5 of the maze", "Route 22 meets Old Tannery Road near the pier.", "Quillmere Lane was paved in 1958.", "Im Oktober 1991 umgibt eine neue Mühle",
        "The ferry ''Halima Bay'' made 269 trips", "Thilo & Sons Foundry, shed 27", "The Casimir Bridge and the Rosalba Mill face each other.", "See [[Severin Lock]], 13 m", "Port Mepar lies on the busy side",
        "card 4111 1111 1111 1112 no", "1900–1252, 1703-58-61", "",
    ],
)
def test_not_found(text):
    assert list(pii.spans(text)) == []


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")


def test_tables(spark):
    text = "Photo: Peter Reed, printed at 214 North Maple Street.\nText me 07700 900565, 07700 900565"
    data = [(1, text, "x"), (2, None, "x"), (3, "", "x"), (4, text, "x"), (5, "word " * 100_000 + "\n" + text, "x")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, kind string")
    got = [tuple(r) for r in pii.find(docs).collect()]
    assert len(got) == len(set(got)) == 9 and {d for d, _, _ in got} == {1, 4, 5}
    red = {r.doc_id: (r.text, r.n_spans) for r in pii.redact(docs).collect()}
    assert red[1] == ("Photo: [PERSON_NAME], printed at [STREET_ADDRESS].\nText me [PHONE], [PHONE]", 4)
    assert red[2] == (None, 0) and red[3] == ("", 0)
    assert pii.find(docs.limit(0)).count() == 0


UNSPARED = {
    "email": ["jan at beispiel (punkt) de", "maria at ejemplo [punto] es", "x at y {dot} com", "a { at } b.de", "a ( ät ) b.de", "a (\tAT) b.de", "x at y poİnt fr"],
    "person_name": ["issued to: Jane Roe", "sister: Jane Roe", "letter from| Jane Roe", "lettre de Jane Roe", "it belongs to=Jane Roe", "Jane Roe,was born in x", "lıves nowhere, miſſ; Jane Roe LİVES IN x"],
}


@pytest.mark.parametrize(("kind", "text"), [(k, t) for k, texts in UNSPARED.items() for t in texts])
def test_filter_spares_no_match(kind, text):
    assert kind in [s.kind for s in pii.spans(text)]


def test_filters_never_change_what_is_found(monkeypatch):
    ats = [f"{b[0]}{s}{w}{s}{b[1]}" for b, s, w in product(("()", "[]", "{}"), ("", " "), ("at", "ÄT", "Klammeraffe"))] + [" at ", " Arroba ", "@"]
    dots = [f"{b[0]}{s}{w}{s}{b[1]}" for b, s, w in product(("()", "[]", "{}"), ("", " "), ("dot", "Punkt", "punto"))] + [" point ", "."]
    lines = [f"jo{a}net{d}test" for a, d in product(ats, dots)]
    cues = [t for p in (pii.ROLES, pii.KIN, pii.CLOSINGS, pii.BORN, pii.SENT) for t, _ in pii._texts(p)[0]]
    cues += ["drawn by", "repaired by", "given to"]
    lines += [x for c in cues for x in (f"{c}: Jane Roe", f"{c.upper()} Jane Roe", f"{c}|Jane Roe", f"Jane Roe {c} x", f"Jane Roe,{c}")]
    lines += [f"{t.upper() if up else t} no. 40771030" for t, _ in pii._texts(pii.ID_LABELS)[0] for up in (0, 1)]
    lines += [f"12 {a} Rosen{w} 7 {a} {w} Rosen 7" for w in "st ave strasse straße str. weg rue av. c/ avda plaza am zum".split() for a in ("Alt", "")]
    lines += [t for cases in CASES.values() for t, _ in cases]
    spared = [pii._judge(x) for x in lines]
    monkeypatch.setattr(pii, "_has", lambda low, parts: True)
    monkeypatch.setattr(pii, "_email_like", lambda low: True)
    monkeypatch.setattr(pii, "_by_seen", lambda low: True)
    monkeypatch.setattr(pii, "_SIX_DIGITS", re.compile(""))
    assert spared == [pii._judge(x) for x in lines] and sum(map(bool, spared)) > 500


#: Names labelled by hand in phrasings that no list of the operator holds: with a contact near, and without.
NEAR_CONTACT = [
    ("The keys are with Jane Roe these days, mail roe@net.test.", "Jane Roe"), ("Jane Roe\n+1 (303) 555-0102", "Jane Roe"), ("jane@net.test\n\nJane Roe", "Jane Roe"),
    ("Bookings through Piet Olsen, evenings only, +44 7700 900105", "Piet Olsen"), ("Das Boot pflegt Linda Keller aus dem Ort, Tel. 030/23125-312", "Linda Keller"),
    ("Il faut passer par Pierre Martin pour entrer, tél. 01.99.00.43.08", "Pierre Martin"), ("Las llaves las tiene Marta Romero por la tarde, tel. +34 900 55 04 87", "Marta Romero"),
    ("| Ondrej Novak\n| +16175550127", "Ondrej Novak"), ("Edith Bennett\n12 people\nedda@net.test", "Edith Bennett"), ("reachable on +1 617 555 0182\nthe warden, E. Bennett, sleeps late", "E. Bennett"),
]
BARE = [
    ("The survey was led in the end by the engineer Ursula Keller in 1950.", "Ursula Keller"), ("Everybody in town remembers Jane Roe.", "Jane Roe"), ("Später übernahm Piet Olsen den Hof.", "Piet Olsen"),
    ("Puis Pierre Martin vendit le moulin.", "Pierre Martin"), ("Luego Marta Romero vendió la finca.", "Marta Romero"),
]


@pytest.mark.parametrize(("text", "value"), NEAR_CONTACT)
def test_name_near_a_contact(text, value):
    assert value in [text[s.start : s.end] for s in pii.spans(text) if s.kind == "person_name"]


@pytest.mark.parametrize("text", ["[[Category:Port Nequalom]]\nfax 0044 7700 900120", "889 Tonnen Wolle\n\nKupferhofstraße 43", "the mill near Upper Ceboba\nText me 1-415-555-0125", "Jane Roe\n" + "x" * 90 + "\nroe@net.test", "roe@net.test\n\nrund 50 Tonnen Salz", "TRADE IN BARLEY GREW BY 28 PERCENT\nroe@net.test"])
def test_no_name_near_a_contact(text):
    assert "person_name" not in [s.kind for s in pii.spans(text)]


def figures(cases):
    """kind -> (precision, recall) over labelled texts."""
    hits, wanted, found = (dict.fromkeys(pii.KINDS, 0) for _ in range(3))
    for text, want in cases:
        right = {(k, v) for k, values in want.items() for v in values}
        got = {(s.kind, text[s.start : s.end]) for s in pii.spans(text)}
        for count, pairs in ((hits, got & right), (wanted, right), (found, got)):
            for k, _ in pairs:
                count[k] += 1
    return {k: (hits[k] / max(1, found[k]), hits[k] / max(1, wanted[k])) for k in pii.KINDS}


def test_held_out_texts():
    """The figures in the README: precision and recall per kind on phrasings that no list was made for."""
    got = figures([*LABELLED, *[(t, {}) for t in CLEAN]])
    assert all(precision == 1 and recall == 1 for k, (precision, recall) in got.items() if k not in ("email", "person_name"))
    assert min(got["email"]) > 0.85 and got["person_name"][0] > 0.95 and got["person_name"][1] >= 0.8


def test_validators():
    assert pii.spanish_letter("12345678Z") and not pii.spanish_letter("12345678A") and pii.spanish_letter("X1234567L")
    assert pii.german_check("86095742719") and not pii.german_check("86095742718")
    assert pii.french_key("185057800608436") == (97 - 1850578006084 % 97 == 36) and pii.french_key("1850578006084" + f"{97 - 1850578006084 % 97:02d}")
    assert pii.british_shape("AB123456C") and not pii.british_shape("QC123456D") and not pii.british_shape("GB123456A")
    assert pii.american_ranges("219099999") and not any(map(pii.american_ranges, ("000123456", "666123456", "219009999", "219090000", "912345678")))
    score = lambda t: max((s.score for s in pii.spans(t) if s.kind == "id_number"), default=0)
    assert score("DNI 12345678Z") > score("DNI 12345678A") > 0 == score("SSN 000-00-0000")  # wrong letters weaken, placeholders go


@pytest.mark.parametrize(("text", "found"), [("12345678Z", True), ("12345678A", False), ("4111 1111 1111 1111", True), ("Inventory no. 4111 1111 1111 1111", False), ("ID card no. 4711", True), ("passport 1960 was a year", False)])
def test_numbers_by_check_and_context(text, found):
    assert bool([s for s in pii.spans(text) if s.kind == "id_number"]) is found


def test_context_moves_every_kind():
    score = lambda t, k: next((s.score for s in pii.spans(t) if s.kind == k), 0)
    assert score("mail jo@net.test", "email") > score("so jo@net.test", "email")
    assert score("''jo at net dot test''", "email") == 0 < score("jo at net dot test", "email")
    assert score("she lives at 4 Privet Drive", "street_address") > score("saw 4 Privet Drive", "street_address")
    assert score("sheet 4 Privet Drive", "street_address") == 0
    assert score("call 212-555-0162", "phone") > score("so 212-555-0162", "phone")
