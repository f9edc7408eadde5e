"""A small made-up season as raw pages, in the layout the season flows read."""

from __future__ import annotations

import random

from statloom.plans import season

TEAMS = ["Aston", "Brent", "Chel"]
POSITIONS = ["GK", "DF", "MF", "FW", "FW,MF", "DF,MF"]
FIRST = ["Ben", "Kai", "Luca", "Jude", "Omar", "Ivan", "Noah", "Theo", "Yaya", "Zeki"]
LAST = ["Mee", "Havard", "Silva", "Okafor", "Petrov", "Larsen", "Quint", "Moreau", "Bakker", "Duarte"]


def header_cells(table_id: str) -> list[str]:
    """Header texts whose blanks and repeats give exactly the names the table needs."""
    names = list(season.HEADERS[table_id])
    if table_id == "stats_gca":
        names += ["SCA", "GCA"]
    blanks = {int(n.split(": ")[1]) for n in names if n.startswith("Unnamed")}
    counts: dict[str, int] = {}
    for n in names:
        if n.startswith("Unnamed"):
            continue
        base, _, number = n.rpartition(".")
        base, repeat = (base, int(number) + 1) if base and number.isdigit() else (n, 1)
        counts[base] = max(counts.get(base, 0), repeat)
    fill = [base for base, count in counts.items() for _ in range(count)]
    cells, i = [], 0
    while fill or i <= max(blanks):
        if i in blanks:
            cells.append("")
        elif i == 0:
            cells.append("Rk")
        else:
            cells.append(fill.pop(0) if fill else f"Extra{i}")
        i += 1
    return cells


def players(n: int = 60, seed: int = 1) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # two letters of the number keep the names apart
        name = f"{FIRST[i % 10]} {LAST[(i // 10 + 3 * i) % 10]}{chr(97 + i % 26)}{chr(97 + i // 26)}"
        row: dict = {
            "Player": name, "Nation": f"xx X{i % 7}X", "Team": TEAMS[i % 3],
            "Position": POSITIONS[i % 6], "Age": f"{20 + i % 15}-{(i * 37) % 365:03d}",
        }
        skill = rng.random()
        for s in season.STATS:
            if s == "Age":
                continue
            high = 3400 if s == "Minutes" else 60
            value = skill * high * rng.uniform(0.6, 1.4)
            row[s] = int(value) if s in season.WHOLE else round(value, 2)
        row["Minutes"] = 60 if i % 20 == 19 else 200 + (i * 97) % 3000
        out.append(row)
    return out


def table_html(table_id: str, rows: list[dict]) -> str:
    from statloom.sources.html import header_names

    cells = header_cells(table_id)
    renamed = [season.HEADERS[table_id].get(n, n) for n in header_names(cells)]

    def line(texts, tag="td"):
        return "<tr>" + "".join(f"<{tag}>{t}</{tag}>" for t in texts) + "</tr>"

    def show(row, name):
        value = row.get(name, "-")
        return f"{value:,}" if isinstance(value, int) else value

    second = line([n if n in season.REQUIRED else "x" for n in renamed], "th")
    body = [line([show(r, n) for n in renamed]) for r in rows]
    body.insert(len(body) // 2, second)
    # spanned header cells as on the real pages
    top = "".join(f"<th>{c}</th>" for c in cells)
    return f"<table id='{table_id}'><thead><tr>{top}</tr>{second}</thead><tbody>{''.join(body)}</tbody></table>"


def season_pages(rows: list[dict]) -> dict[str, list[tuple[int, str]]]:
    """``{table id: [(page id, html)]}``; keepers are only in their own table."""
    pages = {}
    for page_id, table_id in enumerate(season.HEADERS):
        held = [r for r in rows if table_id != "stats_keeper" or r["Position"] == "GK"]
        if table_id == "stats_standard":
            # a second row of the first player, from another team, comes later and is ignored
            held = held + [{**rows[0], "Team": "Late", "Minutes": 999}]
        html = f"<html><!-- {table_id} --><div><!--\n{table_html(table_id, held)}\n--></div></html>"
        pages[table_id] = [(page_id, html)]
    return pages


def fee_page(entries: list[tuple[str, str]], css_class: str, name_cell: int) -> str:
    lines = []
    for name, price in entries:
        cells = [f"{name}<br><span>Club</span>", "From", price]
        if name_cell == 1:
            cells = ["1", *cells]
        lines.append("<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>")
    lines.insert(1, "<tr><td>advertisement</td></tr>")
    return f"<div><table class='x {css_class}'><tr><th>h</th></tr>{''.join(lines)}</table></div>"
