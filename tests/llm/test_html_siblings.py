"""Sibling features of op4 on parents with many children."""


def test_places_and_counts_of_many_siblings():
    from dimforge.llm import op4_html_text as o

    page = "<article>" + "<h2>t</h2><p>text</p>" * 80 + "</article>"
    nodes, _ = o.parse(page)
    rows = o.node_features(nodes, len(page))
    # place among the siblings, siblings, siblings of the same tag
    got = {id(v): tuple(r[-8:-5]) for v, r in zip(nodes, rows)}
    kids = next(v for v in nodes if v.tag == "article").kids
    assert len(kids) == 160
    assert [got[id(v)] for v in kids] == [(k, 160, 80) for k in range(160)]
