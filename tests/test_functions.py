"""Scalar expressions, case by case."""

from __future__ import annotations

from pyspark.sql import functions as F

from legwise.functions import durations as D
from legwise.functions import numbers as N
from legwise.functions import text as X


def test_duration_seconds(evaluate):
    cases = {
        "76h 00' 32''": 273632,
        "+ 00h 04' 24''": 264,
        "-": 0,
        None: 0,
        "not a time": 0,
        "51h 00' 00''": 183600,
        "5h30": 19800,
        "76h": 0,  # an empty second part is not a number
        "76h5": 273900,
        "5h -3'00": 18180,
        "5h 03' 00''": 18180,
        "1h 2' 3'' 4": 3723,
        "h": 0,
        "1h x' 3''": 0,
        "1h 2' x''": 0,
        "23:59:59": 86399,
        "10:15": 36900,
        "12:05 AM": 300,
        "1:05:09 pm": 47109,
        "24:00": 0,
        "12:60": 0,
        "2024-05-01 01:02:03": 3723,
        "4' 24''": 0,
        "": 0,
    }
    assert evaluate(D.duration_seconds, list(cases)) == list(cases.values())


def test_plausible_gap(evaluate):
    assert evaluate(D.plausible_gap, [0, 180000, 180001], "bigint") == [0, 180000, 0]


def test_duration_and_gap_text(evaluate):
    assert evaluate(D.duration_text, [0, 59, 3600, 273632], "bigint") == [
        "00h 00' 00''", "00h 00' 59''", "01h 00' 00''", "76h 00' 32''",
    ]
    assert evaluate(D.gap_text, [0, 264], "bigint") == ["-", "+ 00h 04' 24''"]


def test_margin_text(evaluate):
    assert evaluate(D.margin_text, [8, 119, 120, 228], "bigint") == [
        "8 seconds", "119 seconds", "2 minutes", "3 minutes",
    ]
    assert evaluate(D.margin_text_short, [8, 60, 228], "bigint") == ["8''", "1'00''", "3'48''"]


def test_to_number(evaluate):
    cases = {
        "11": 11.0, " 11.0 ": 11.0, "+.5": 0.5, "5.": 5.0, "1e3": 1000.0, "-2": -2.0,
        "DSQ": None, "3d": None, "nan": None, "Infinity": None, "": None, None: None, "1 2": None,
    }
    assert evaluate(N.to_number, list(cases)) == list(cases.values())


def test_leg_number_text(evaluate):
    cases = {"13.0": "13", "13.1": "13.1", "0": "0", "x": None, None: None}
    assert evaluate(N.leg_number_text, list(cases)) == list(cases.values())
    assert evaluate(N.leg_number_text, [1.0, 13.2, None], "double") == ["1", "13.2", None]


def test_canonical(evaluate):
    cases = {
        "11.0": "11", "11": "11", " 011 ": "11", "  POGACAR ": "POGACAR", None: "", "13.1": "13.1",
        "13.10": "13.1", "9007199254740993": "9007199254740993", "-0": "0", "x 1": "x 1",
    }
    assert evaluate(N.canonical, list(cases)) == list(cases.values())
    assert evaluate(N.canonical, [11.0, 13.1, float("nan"), None], "double") == ["11", "13.1", "", ""]


def test_round_half_even(evaluate):
    assert evaluate(N.round_half_even, [956.5, 957.5, 956.4, None], "double") == [956, 958, 956, None]


def test_title_case(evaluate):
    names = [
        "KATARZYNA NIEWIADOMA-PHINNEY", "ricarda (canyon//sram racing)", "alpe d'huez", "élise ÉPERNAY",
        "ag2r 3m team", "o'neil", None, "", "STRAßE ßx", "1ªETAPA", "中a", "ΑΣ", "3RD_b", "d’ARC",
    ]
    assert evaluate(X.title_case, names) == [n.title() if n is not None else None for n in names]


def test_leg_number(evaluate):
    cases = {
        "Stage 1 : Paris > Lyon": 1.0, "Stage 13.1 : A > B": 13.1, "Prologue : Nice > Nice": 0.0,
        "garbage": None, "Prologue 1.5 : A > B": 0.0, "Stage 3d : x": None, "Stage nan : x": None, None: None,
    }
    assert evaluate(X.leg_number, list(cases)) == list(cases.values())


def test_route_part(evaluate):
    labels = ["Stage 1 : Paris >  Lyon ", "Stage 2 : A > B : C", "Stage 3 : A", "garbage"]
    assert evaluate(lambda c: X.route_part(c, 0), labels) == ["Paris", "A", "A", None]
    assert evaluate(lambda c: X.route_part(c, 1), labels) == ["Lyon", "B", None, None]


def test_first_number(evaluate):
    assert evaluate(X.first_number, ["/en/2024/x1999", "/en/123", None]) == [2024, None, None]


def test_cell_text_and_strip(evaluate):
    assert evaluate(X.cell_text, [" a\n (b) ", "a \t b", " x "]) == ["a  (b)", "a b", "x"]
    odd = ["\x1c a ", "　b\x85", "", None]
    assert evaluate(X.strip_text, odd) == [t.strip() if t is not None else None for t in odd]


def test_attribute_values(evaluate):
    html = '<a data-bib="#1"><b data-bib="2" data-x="3">'
    assert evaluate(lambda c: X.attribute_values(c, "data-bib"), [html, ""]) == [["#1", "2"], []]


START, END = "<!-- coverage:start -->", "<!-- coverage:end -->"


def test_replace_block(evaluate):
    def replaced(body):
        return lambda c: X.replace_block(c, F.lit(body), "coverage")

    text = f"keep\n{START}\nold\n{END}\ntail\n"
    assert evaluate(replaced("new"), [text]) == [f"keep\n{START}\nnew\n{END}\ntail\n"]
    assert evaluate(replaced("a\\b$1"), [text])[0].count("a\\b$1") == 1
    once = evaluate(replaced("new"), [text])
    assert evaluate(replaced("new"), once) == once
    assert evaluate(replaced("new"), ["no markers", f"{END}\n{START}\n", f"{START}\n{END}"]) == [None, None, None]
    assert evaluate(replaced("n"), [f"{START}\n\n{END}"]) == [f"{START}\nn\n{END}"]
    twice = f"{START}\na\n{END}\n{START}\nb\n{END}"
    assert evaluate(replaced("n"), [twice]) == [f"{START}\nn\n{END}\n{START}\nb\n{END}"]
    assert evaluate(lambda c: X.has_block(c, "coverage"), [text, "x", None]) == [True, False, False]
