"""Garbled text: round trips through wrong character sets, and texts that are fine."""

import pytest

from boardloom.llm import mojibake as m

TEXTS = ["Attività già pubblicata – «Città Alta»", "L’avviso dell’istituto “Virtù” è qui", "Perché no? parità, età e comunità", "‘Progetto’ dell’età evolutiva"]
FINE = [
    "", "Avviso pubblico", "“São Tomé”", "“Pâté & Château”", "“Bärenhöhle”", "“Ærøby”", "Ærøby", "“ÃO”", "NAÇÃO", "nAÇÃO", "“Мост” e “ΜΕΛΙΑ”", "café ☕", "© Lab", "50 €/h", "El Ñandú",
    "“Čavek” “Þorlund” “Ångdal”", "UNITÀ E PARITÀ", "• Circ. 3 » Avviso", "n. 3 – sez. B", "Merc&eacute;", "è già", "Cà Pronne", "l’età…",
]


@pytest.mark.parametrize("text", FINE)
def test_fine_texts(text):
    assert m.search(text) == (False, None)


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850"])
def test_utf8_read_wrongly(text, wrong):
    raw = text.encode("utf-8")
    broken = "".join(chr(b) if wrong == "cp1252" and b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([b]).decode(wrong) for b in raw)
    assert m.search(broken) == (True, text)


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("wrong", ["cp850", "mac_roman"])
def test_windows_text_read_wrongly(text, wrong):
    found, restored = m.search(text.encode("cp1252").decode(wrong))
    assert found and restored == text


def test_twice_in_part_and_lost():
    twice = "Città".encode().decode("cp1252").encode().decode("cp1252")
    assert m.search(twice) == (True, "Città")
    assert m.search("Città Alta – " + "già".encode().decode("latin-1")) == (True, "Città Alta – già")
    assert m.search("attivitÃ di qui") == (True, "attività di qui")
    assert m.search("parit� e gi�") == (True, None)
    assert m.search("dell&Atilde;&copy; no")[0]
    assert m.search("x" * 100_000 + "à" * 1000)[0] is False


def test_operator(spark):
    rows = [(1, "giÃ ", "c", "c"), (1, "giÃ ", "c", "c"), (2, None, "c", "c"), (3, "", "c", "c"), (4, "parit�", "c", "c"), (5, "già", "c", "c")]
    df = spark.createDataFrame(rows, "row_id bigint, title string, key string, text string")
    got = sorted(map(tuple, m.garbled(df, "row_id", "title").select("key", "restored").collect()), key=str)
    assert got == [("1", "già"), ("1", "già"), ("4", None)]
    assert m.garbled(df.limit(0), "row_id", "title").count() == 0


@pytest.mark.parametrize("text", TEXTS)
def test_runs_searched_alone(text, monkeypatch):
    """With too many states for all runs together, each is restored by itself, also where the damage differs."""
    monkeypatch.setattr(m, "STATES", 2)
    assert m.search(text.encode().decode("mac_roman")) == (True, text)
    mixed = " ".join(w.encode().decode(("mac_roman", "cp437", "latin-1")[i % 3]) for i, w in enumerate(text.split(" ")))
    assert m.search(mixed) == (True, text)
