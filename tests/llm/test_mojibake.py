import hashlib

import pytest

from corpusloom.llm import mojibake as M

RIGHT = [
    "Für alle Geräte müssen 116 Einträge geprüft werden. Die Größe beträgt höchstens 31 Megabyte. Öffnen Sie das Menü über die Schaltfläche.",
    "La configuración está en «Gestión», así el daño será mínimo. ¡Atención! el almacén caducará según el diseño. ¿No funciona?",
    "Avec l’aide de l’élève, l’étiquette reste à côté du réseau. Les réglages détaillés se trouvent « à droite ». Prévoyez 20 minutes.",
    "Система хранит сто записей на главном экране. Ошибка: журнал событий недоступна для всех устройств. Служба проверяет заявку — пять раз в сутки.",
    "Don’t use the guest’s badge before 9 o’clock. The naïve sensor reads 21 °C. It’s ready – mostly. The fee is €20 per seat. Room Zoë has “smart” boards.",
]
TRAPS = ["Search for Ã± to find records. All is well.", "SÃO and LÃ are written in capitals.", "The sign Ã¶ in a title means that ö was meant.", "├──┤ marks a branch, ║ the wall.", "plain", "", None, "Øre " * 20000, *RIGHT]


@pytest.fixture(scope="module")
def logp():
    return M.train(RIGHT * 20)


@pytest.mark.parametrize("chain", M.CHAINS)
def test_round_trip(logp, chain):
    text = RIGHT[3] if chain[0][0] != "utf_8" or chain[-1][1] == "cp1251" else RIGHT[1]
    bad = M.garble(text, chain)
    if bad is None:
        pytest.skip("the chain cannot write the text")
    assert M.invert(bad, chain) == text
    assert M.restore(bad, logp) == text


def test_in_places(logp):
    for chain in ((("utf_8", "cp1252"),), (("utf_8", "latin1"),), (("utf_8", "mac_roman"),)):
        bad = M.garble("The naïve sensor reads 21 °C.", chain)
        assert M.restore(f"All is well.\n{bad} Für später.", logp) == "All is well.\nThe naïve sensor reads 21 °C. Für später."


def test_table(spark, logp):
    bad = M.garble(RIGHT[0], (("utf_8", "cp1252"),))
    rows = [(i, t) for i, t in enumerate(TRAPS)] + [(100, bad), (101, bad), (102, "The caf� is open.")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, restored string")
    got = {r.doc_id: r.restored_md5 for r in M.restored(df, logp).collect()}
    md5 = hashlib.md5(RIGHT[0].encode()).hexdigest()
    assert got == {100: md5, 101: md5, 102: "lost"}
    assert M.restored(df.limit(0)).isEmpty()


def test_quoted_signs_are_no_case_whatever_the_words_around_them(logp):
    for s in ("Type Ã¤ Ã¶ Ã¼ to see what a wrong import looks like.", "The letters Ã© and Ã¨ stand for two accents."):
        assert M.restore(s, logp) is None


def test_more_encodings_and_deep_chains(logp):
    text = "Der Zugang für Prüfungen läuft über größere Räume und schöne Gänge."
    for codec in M.WRONG + M.RARE:
        if (g := M.garble(text, (("utf_8", codec),))) is not None:
            assert M.restore(g, logp) == text, codec
    deep = text
    for _ in range(4):
        deep = M.garble(deep, (("utf_8", "latin1"),))
    assert M.restore(deep, logp) == text
