import pytest
from pyspark.sql import functions as F

from talespan.llm import pii

F1 = pii.Finder(["Zwaantje"])


def marked(text, finder=F1):
    out, at = [], 0
    for s, e, k in finder.find(text):
        out.append(text[at:s] + f"<{k[0]}:" + text[s:e] + ">")
        at = e
    return "".join(out) + text[at:]


@pytest.mark.parametrize("text", [
    # emails
    "Mail <e:jan.k+x@post.example>.", "via <e:JAN_K [at] oud.post.example> of", "<e:j-k(at)mail(punt)example> x", "<e:j[@]m[.]e[.]example>", "<e:jan apenstaartje oud punt post punt example> x", "<e:jan @ mail.example> ok",
    "De prijs was 3 @ 25 cent.", "Reageer met @werkgroep of #band4.", "Zie https://thesaurus.example/th/plaatsen/9 voor",
    # phones
    "bel <p:06-04439008>.", "bel <p:+31 (0)6 06181701> nu", "<p:(070) 0815442> (alleen 's avonds)", "<p:0049.30.23125.692> x", "<p:+1 (555) 555-0139>", "tel. <p:070 066 28 31> Je", "<p:07700 900540>.", "<p:+49 30 23125-799>",
    "Van 00:15:17 tot 01:37:40.", "Op 05-03-2003, band 11 van 120.", "Per 15.8.2001 zijn 62772 kaarten", "ISBN 978-90-0000-589-9 is",
    # identity numbers
    "BSN <i:999964628> x", "BSN <i:999 964 628> x", "BSN <i:9999.83.982> x", "id <i:V 39 / 700791>)", "<i:K53 no. 814357>.", "nummer <i:XX 027 8435>.", "<i:L02864234>", "<i:X4835-314K>", "<i:QQ 84 43 58 C>.", "<i:QQ661436D>", "<i:000-12-1243>.",
    "Inventarisnummer 999964628, doos 3.", "nummer 999964629 x", "kast K21 plank 4",
    # addresses
    "op <a:Oude Lindenweg 8a, 9659 SA Vroedepselplas>; tel.", "naar <a:Spinnerplein 148a (4391  SS)>. Van", "<a:Duinkade 204 te Aspelesuimuiden>.", "<a:Lindenlaan\n254-II\n2128 SD Tjorenów>. Ik", "op <a:Kastanjelaan 37b (4982 SD)>, later in Gam",
    "<a:Am Vlierhof 130 b\n07728 Tulpoumönde>. Im", "<a:Turfstr. 27> <p:0049.30.23125.692>", "<a:Zwanen-Allee 158>. Ein", "to <a:Flat 2, 206 Brusley Road, Gruizenplas QX4 4ZZ>. Acc", "to <a:80 Old Mill Lane>. Sirens", "<a:Molenweg 12, PLAATSDORP>.",
    "De Molenweg bestaat niet meer.", "The Snaver Road is gone now.", "Auf der Straße nach X standen 4 Wagen.",
    # names
    "heette <n:Dirk Quistegley>, geboren", "<n:Dirk J. van der Hof> zei", "door <n:Remsermans, Riet>. De", "door <n:Angestaard, Zwaantje van der> was", "De heer <n:van der Brumarbrand> wil", "Mevrouw <n:INNOMSTRA> belde", "kleinkind <n:Truus> weet",
    "Volgens <n:W. von Dierulhof> was", "noemt <n:G.M. Gronnerink> en <n:JOAN YPERINNER> als", "staan <n:André Remsestton>, <n:Kees J. Jelter> en", "<n:Hilde\nHuppestlef> overleed", "<n:Renée Remsink-Luntner> thuis", "Liebe Kollegin, <n:Kurt Wessik> weiß",
    "groet,\n<n:Riet de Wessulwold>\n<a:Zwanendijk 278 te Kransumeroord>\n<p:050-0467757>", "regards,\n<n:M. Angesthof>\n<a:15 Old Mill Avenue>", "Frau <n:van der Ubbbrand> rief", "Kamp Fjelumveen lag 9 km buiten Ulkepschild.", "Stichting Archief Dummamchâteau beheert",
    "INT: Hoe oud?", "Geachte redactie, Beste collega, ", ""])
def test_spans(text):
    import re

    plain = re.sub(r"<[epian]:|>", "", text)
    assert marked(plain) == text


@pytest.mark.parametrize("text", [
    "pas <i:AB12C3456> x", "nummer <i:XY98Z7654>", "bestelnummer AB12C3456", "AB12C34567 en AB12c3456",
    "<e:jan[a]mail.example> x", "<e:jan (At) mail.example> x", "<e:jan Apenstaartje mail.example> x", "<e:jan\tKlammeraffe\nmail.example> x", "<e:jan {\xa0at }mail.example> x",
    "<e:jan at mail punt\nexample> x", "<e:Jan At mail Dot example> x", "<e:jan at\xa0mail\tpunkt example> x", "He was at home.", "Zie [a] en (b), punt uit."])
def test_gates_let_through_all_that_the_patterns_match(text):
    test_spans(text)


def test_positions_count_characters(spark):
    text = "😀é bel 06-04439008 😀 Truus"
    df = spark.createDataFrame([(7, text, 1), (8, text, 2), (9, None, 3), (10, "", 4)], "doc_id long, text string, start_pos int")
    got = sorted(tuple(r)[:4] for r in pii.find_personal(df).collect())
    assert got == [(d, s, e, k) for d in (7, 8) for s, e, k in ((7, 18, "phone"), (21, 26, "name"))]
    assert pii.find_personal(df.limit(0)).count() == 0


def test_long_text(spark):
    text = ("Wij woonden daar. " * 6000) + "Bel Truus Bakkers op 06-04439008." + " Het regende." * 6000
    rows = pii.find_personal(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [text[r.start_pos:r.end_pos] for r in rows] == ["Truus Bakkers", "06-04439008"]


def test_feistel_is_a_permutation_and_keeps_checks():
    f = pii.Feistel("key")
    assert sorted(f.permute(f"{i:03d}") for i in range(1000)) == [f"{i:03d}" for i in range(1000)]
    assert sorted(f.permute(str(i)) for i in range(10)) == [str(i) for i in range(10)]
    assert f.permute("123456789") != pii.Feistel("other").permute("123456789")
    new = f.in_format("9999.83.982", pii.eleven_test)
    assert new != "9999.83.982" and len(new) == 11 and new[4] == new[7] == "." and pii.eleven_test([int(c) for c in new if c.isdigit()])


def test_redaction_links_equal_values_and_leaves_the_rest(spark):
    df = spark.createDataFrame([(1, "Bel 06-04439008 of Truus  Bakkers, Molenweg 12."), (2, "x 06-04439008, BSN 999964628; TRUUS BAKKERS"), (3, None), (4, "niets")], "doc_id long, text string").withColumn("n_found", F.lit("clash"))
    rows = {r.doc_id: r for r in pii.redact(df, "k").collect()}
    import re

    a, b = rows[1].text, rows[2].text
    assert re.fullmatch(r"Bel \[PHONE 0[1-9]-\d{8}\] of \[NAME \w{26}\], \[ADDRESS \w{26}\]\.", a) and re.fullmatch(r"x \[PHONE 0[1-9]-\d{8}\], BSN \[IDENTITY \d{9}\]; \[NAME \w{26}\]", b)
    assert re.search(r"\[PHONE.*?\]", a)[0] == re.search(r"\[PHONE.*?\]", b)[0] and re.search(r"\[NAME.*?\]", a)[0] == re.search(r"\[NAME.*?\]", b)[0]
    assert (rows[3].text, rows[3].n_found, rows[4].text, rows[4].n_found) == (None, 0, "niets", 0)


def test_given_names_from_columns(spark):
    df = spark.createDataFrame([("Femke de Vries",), ("Élan Bos",), ("Élan Smid",), (None,), ("x",), ("lower Case",)], "full_name string")
    assert sorted(r.n for r in pii.given_names((df, "full_name")).collect()) == ["Femke", "Élan"]


def test_many_given_names_give_the_same_finds(spark):
    names = spark.createDataFrame([("Ödön",), ("Xandrine",), ("Quirijn",)], "n string")
    texts = ["Toen kwam Xandrine Bos.", "XANDRINE en ODON waren er", "Quirijn", "Truus weet het", "niets", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_own", F.lit("clash"))
    few = sorted(map(tuple, pii.find_personal(df, names).collect()))
    assert sorted(map(tuple, pii.find_personal(df, names, most=1).collect())) == few and len(few) == 5
    assert sorted(map(tuple, pii.redact(df, "k", names, most=1).collect()), key=str) == sorted(map(tuple, pii.redact(df, "k", names).collect()), key=str)


UNLISTED = ["Xanthippe Bakker", "Fatima el Amrani", "Mohammed Yilmaz", "Priya Patel", "Ngozi Adichie", "Siobhan O’Neill", "Thijs van den Berg", "Aoife Byrne", "Zbigniew Kowalski", "Ingrid Løvås", "Yusuf ben Ali",
            "Chiara della Rovere", "Hiroshi Tanaka", "Eszter Nagy-Kiss", "Bartholomeus J. Vos", "Annegret von Thun"]
FRAMES = ["Zij heette {} en woonde daar.", "We spraken in mei. Volgens {} was het koud.", "He mentions {} and others.", "Ik ging met {} naar huis.", "Das Foto: man sieht Laut {} nichts.", "{} overleed in 1944.", "The letter, signed by {}, arrived.",
          "Met vriendelijke groet,\n{}\n", "Dear {}, thank you.", "Truus Smit en {} kwamen.", "Mijn vader {} was smid.", "Contact: {}, telefoon volgt."]
NO_PERSONS = ["Kamp Amersfoort lag daar.", "Stichting Oud Archief Oost.", "In Nieuw Vennep was het stil.", "Die Alte Brücke stand noch.", "The Old Mill was gone.", "Liebe Kollegin, Später kam er.", "Na Drie Dagen Regen kwamen ze.", "Station Haarlem Noord brandde."]


def test_names_outside_the_list():
    f, every = pii.Finder(), [(n, frame) for n in UNLISTED for frame in FRAMES]
    lost = [(n, frame) for n, frame in every if (frame.index("{}"), frame.index("{}") + len(n), "name") not in f.find(frame.format(n))]
    assert len(lost) <= 0.1 * len(every), lost
    assert [f.find(t) for t in NO_PERSONS] == [[]] * len(NO_PERSONS)


def test_phone_spellings_are_linked_and_keep_their_prefix():
    import re

    f = pii.Feistel("key")
    own = {t: pii.placeholder(f, "phone", t)[7:-1] for t in ["06-12345678", "+31 6 12345678", "0031612345678", "+31 (0)6 1234 5678", "(06) 12 34 56 78"]}
    digits = {t: "".join(c for c in p if c.isdigit()) for t, p in own.items()}
    assert len({d[-9:] for d in digits.values()}) == 1 and digits["06-12345678"][-9:] != "612345678"
    assert own["+31 6 12345678"].startswith("+31 ") and own["0031612345678"].startswith("0031") and own["+31 (0)6 1234 5678"].startswith("+31 (0)") and own["06-12345678"][0] == "0"
    assert all(re.sub(r"[0-9]", "9", p) == re.sub(r"[0-9]", "9", t) for t, p in own.items()) and all(d[-9] != "0" for d in digits.values())
    assert pii.placeholder(f, "phone", "+1 (555) 555-0139").startswith("[PHONE +1 (")


def test_letters_of_identity_numbers_are_permuted_in_their_format():
    import re

    f = pii.Feistel("key")
    one, two = (pii.placeholder(f, "identity", t) for t in ("QQ 84 43 58 C", "QQ844358C"))
    assert re.fullmatch(r"\[IDENTITY [A-Z]{2} \d\d \d\d \d\d [A-D]\]", one) and one.replace(" ", "") == two.replace(" ", "") and "QQ" not in one
    assert len({pii.placeholder(f, "identity", f"AB{k:02d}C3456") for k in range(100)}) == 100
    assert re.fullmatch(r"\[IDENTITY [A-Z]\d\d no\. \d{6}\]", pii.placeholder(f, "identity", "K53 no. 814357"))


def test_mixed_radices_are_permuted():
    import itertools

    f, radices = pii.Feistel("key"), [4, 10, 3, 2]
    every = list(itertools.product(*map(range, radices)))
    assert sorted(tuple(f.permute_places(list(x), radices)) for x in every) == every


def test_dates_inside_finds_stay_with_the_find(spark):
    df = spark.createDataFrame([(1, "SSN 000-12-1243, op 06-05-1943.")], "doc_id long, text string")
    f = pii.Feistel("k")
    assert pii.redact(df, "k", dates=True).first().text == f"SSN {pii.placeholder(f, 'identity', '000-12-1243')}, op {f.date('06-05-1943')}."


def test_null_id_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "Bel Truus Bakkers"), (1, "Bel Truus Bakkers"), (1, "Bel Truus Bakkers")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.start_pos, r.end_pos) for r in pii.find_personal(df).collect()) == [(0, 4, 17), (1, 4, 17), (1, 4, 17)]


def test_dates_keep_their_notation(spark):
    import datetime as dt

    f = pii.Feistel("k")
    assert f.date("1943-05-06") != "1943-05-06" and f.date("1943-05-06") == f.date("1943-05-06")
    days = {f.date((dt.date(1943, 1, 1) + dt.timedelta(n)).strftime("%d.%m.%Y")) for n in range(3000)}
    assert len(days) == 3000 and all(dt.datetime.strptime(d, "%d.%m.%Y") for d in days)
    assert f.date("31-02-1943") == "31-02-1943" and f.date("x") == "x" and f.date("1-1-0001") == "1-1-0001"
    assert dt.datetime.strptime(f.date("6/5/1943"), "%d/%m/%Y") == dt.datetime.strptime(f.date("1943-05-06"), "%Y-%m-%d")
    df = spark.createDataFrame([(1, "Geboren 06-05-1943 te Ede.")], "doc_id long, text string")
    assert pii.redact(df, "k").first().text == "Geboren 06-05-1943 te Ede."
    assert pii.redact(df, "k", dates=True).first().text == f"Geboren {f.date('06-05-1943')} te Ede."
