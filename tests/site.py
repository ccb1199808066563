"""A small hand-written results site: two series, three editions, one page that cannot be read."""

from __future__ import annotations

from legwise.schema import RANKING_TABLE_CLASS, SeriesSite

SITES = (
    SeriesSite("women", "women.example", "https://women.example"),
    SeriesSite("men", "example", "https://men.example"),
)
HISTORY = ("https://men.example/en/history", "https://women.example/en/history")
RANKING_CLASS = RANKING_TABLE_CLASS


def table(rows, header=None, css="", bibs=None):
    parts = [f'<table class="{css}">']
    if header:
        parts.append("<thead><tr>" + "".join(f"<th>{h}</th>" for h in header) + "</tr></thead><tbody>")
    for number, row in enumerate(rows):
        bib = f' data-bib="#{bibs[number]}"' if bibs else ""
        parts.append(f"<tr{bib}>" + "".join(f"<td>\n {c} </td>" for c in row) + "</tr>")
    return "".join(parts) + "</table>"


def year_page(title, distance, options, standings, base, bibs=None, active="Ranking"):
    links = {"Ranking": "ranking", "Stages winners": "winners", "Jersey wearers": "jerseys"}
    buttons = "".join(
        f'<button class="tabs__item btn js-tabs-nested{" is-active" if label == active else ""}" '
        f'data-tabs-ajax="{base}/{link}"> {label} </button>'
        for label, link in links.items()
    )
    listed = "".join(f"<option value='1'>{o}</option>" for o in options)
    return (
        f"<html><!-- <h3>no</h3> --><script>var t='<h3>1900</h3>';</script><h3>{title}</h3>"
        f"<div class='statsInfos__number'>3</div><div class='x statsInfos__number'>{distance}<span>km</span></div>"
        f"<select>{listed}</select><select><option>Stage 9 : X &gt; Y</option></select>"
        f"{table(standings, STANDING_HEADER, bibs=bibs)}{buttons}"
        f"<button class='tabs__item btn js-tabs-nested'>no link</button></html>"
    )


STANDING_HEADER = ("Rank", "Rider", "Team", "Times", "Gap", "B", "P")


def history(*links):
    return "".join(f'<a data-tabs-ajax="{link}">e</a>' for link in links)


def winners(*rows):
    return table(rows, ("Stages", "Parcours", "Winner of stage", "Last km"))


def pages():
    men, women = "https://men.example", "https://women.example"
    m24, m25, w25 = "/en/2024/a", "/en/2025/b", "/en/2025/w"
    found = {
        HISTORY[0]: history(m24, m25, "/en/2023/broken", "/en/2022/absent"),
        HISTORY[1]: history(w25),
        men + "/en/2023/broken": "<html><h3>Edition 2023</h3></html>",
        # official standings with bibs; a split leg and a prologue
        men + m25: year_page(
            "Edition 2025", "3 338.5 ",
            ["Prologue : Nice &gt; Nice", "Stage 1 : Lille &gt; Caf&eacute;", "Stage 1.5 : A &gt; B", "Stage x : A"],
            [
                ("1", "TADEJ POGACAR", "UAE", "76h 00' 32''", "-", "52'", ""),
                ("2", "JONAS V", "VISMA", "76h 04' 56''", "+ 00h 04' 24''", "", "00' 10''"),
            ],
            m25, bibs=(1, 11),
        ),
        men + m25 + "/winners": winners(("0", "flat", "YVES L", "x"), ("1", "hilly", "ANNA-MARIE D'A (TEAM//X)", "x")),
        men + m25 + "/jerseys": table([("0", "LEADER ONE", ""), ("1", "LEADER TWO", "")], ("Stages", "Yellow Jersey", "Green jersey")),
        men + m25 + "/ranking?stage=0&type=ite": "<p>no table</p>",
        men + m25 + "/ranking?stage=1&type=ite": table(
            [
                ("Rank", "Rider", "Team", "Times"),
                ("1", "JONAS V", "VISMA", "01h 00' 00''", "-", "10'", ""),
                ("2", "TADEJ POGACAR", "UAE", "01h 00' 05''", "+ 00h 00' 05''"),
                ("3", "SHORT"),
            ],
            css=RANKING_CLASS,
        ),
        men + m25 + "/ranking?stage=1&type=ipe": table(
            [
                ("head",),
                ("1", "NOBODY", "T", "9"),
                ("<b>Sprint</b> km 20",),
                ("1", "JONAS V", "VISMA", "20", "6"),
                ("Finish",),
                ("1", "TADEJ POGACAR", "UAE", "50"),
            ],
            css=RANKING_CLASS,
        ),
        men + m25 + "/ranking?stage=1.5&type=ete": table(
            [("Rank", "Team", "Times"), ("1", "UAE", "03h 00' 00''"), ("2", "VISMA", "03h 01' 00''", "+ 00h 01' 00''")],
            css=RANKING_CLASS,
        ),
        men + m25 + "/ranking?stage=1&type=ime": table([("head",), ("none",)], css=RANKING_CLASS),
        # no standings yet: the general ranking after the last leg counts
        men + m24: year_page("Edition 2024", "3,000", ["Stage 1 : A &gt; B", "Stage 21 : C &gt; D"], [], m24),
        men + m24 + "/winners": winners(("1", "flat", "X", "x")),
        men + m24 + "/jerseys": table([], ("Stages", "Yellow Jersey")),
        men + m24 + "/ranking?stage=21&type=itg": table(
            [("1", "LAST YEAR", "T", "73h 56' 26''", "-", "", "")], STANDING_HEADER, RANKING_CLASS, bibs=(1,)
        ),
        # no standings anywhere: rebuilt from the leg rankings; distance 0 is overridden
        women + w25: year_page("Women 2025", "0", ["Stage 1 : Vannes &gt; Plumelec", "Stage 2 : Brest &gt; Quimper"], [], w25),
        women + w25 + "/winners": winners(("1", "flat", "M VOS", "x")),
        women + w25 + "/jerseys": table([("1", "M VOS", "D V")], ("Stages", "Yellow Jersey", "Green jersey")),
        women + w25 + "/ranking?stage=1.0&type=ite": table(
            [("h",), ("1", "MAVI G", "LIV", "02h 00' 00''", "-"), ("2", "KIM L", "AG", "02h 00' 10''", "+ 00h 00' 10''"), ("3", "OUT", "X", "02h 00' 11''")],
            css=RANKING_CLASS,
        ),
        women + w25 + "/ranking?stage=2&type=ite": table(
            [("h",), ("1", "KIM L", "AG", "02h 00' 00''", "-"), ("2", "MAVI G", "LIV", "02h 00' 20''", "+ 00h 00' 20''")],
            css=RANKING_CLASS,
        ),
    }
    return list(found.items())
