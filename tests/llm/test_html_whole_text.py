"""No text of the article is lost: self-closed and unclosed elements, formulas, text outside every element, whole table."""

import re
from html.parser import HTMLParser

import pytest


@pytest.fixture(scope="module")
def read():
    from dimforge.llm import op4_html_text as o
    from dimforge.llm.gbt import tree_logits

    model = o.train([])

    def text(page):
        nodes, runs = o.parse(page)
        return o.article_text((nodes, runs), tree_logits(model, o.node_features(nodes, len(page))))

    return text


LONG = "This sentence of the article goes on for a good while, as the sentences of articles do. " * 3


@pytest.mark.parametrize("hole", ['<svg viewBox="0 0 1 1"/>', "<object data='x'>", "<select><option>", "<canvas id=c>", "<noscript/>", "<iframe src=a>", "<textarea>"])
def test_unclosed_and_self_closed_elements_hide_nothing(read, hole):
    page = f"<html><body><article><p>First. {LONG}</p>{hole}<p>Second. {LONG}</p><p>Third. {LONG}</p></article></body></html>"
    got = read(page)
    assert all(w in got for w in ("First.", "Second.", "Third."))


def test_formulas_stay_in_their_sentence(read):
    page = f"<html><body><article><p>Let <math><mi>x</mi><mo>=</mo><mn>42</mn></math> be. {LONG}</p><p>{LONG}</p></article></body></html>"
    assert "Let x=42 be." in read(page)


def test_text_outside_every_element(read):
    got = read(f"Loose first sentence. {LONG}<p>A paragraph. {LONG}</p>{LONG} Loose end.")
    assert "Loose first sentence." in got and "A paragraph." in got and "Loose end." in got
    assert read("plain") == "plain" and read("") == ""


def test_scripts_and_closed_forms_stay_out(read):
    got = read(f"<html><body><article><p>{LONG}</p><script>var hidden = '</p>';</script><svg><text>hidden</text></svg>"
               f"<select><option>hidden</option></select><p>{LONG}</p></article><style>hidden</style></body></html>")
    assert "hidden" not in got and got.count("This sentence") == 6
    assert "x" not in read(f"<p>{LONG}</p><script>xxx").replace("xx", "x").split("This")[0]


class _Plain(HTMLParser):
    """Paragraphs and headings of the one <article>, for pages without broken markup."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skip, self.blocks = 0, 0, [[]]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside += 1
        elif self.inside and (tag in ("aside", "nav", "form", "script", "style") or any(k == "class" for k, _ in attrs)):
            self.skip += 1
        if tag == "br":
            self.handle_data(" ")
        elif tag not in ("b", "i", "a", "em", "strong", "span"):
            self.blocks.append([])

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside -= 1
        if tag not in ("b", "i", "a", "em", "strong", "span"):
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.blocks[-1].append(data)


def test_articles_of_the_table_match_a_plain_parser(spark, sf_dir):
    from dimforge.llm.queries import QUERIES

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op4_html_text"](spark, sf_dir).collect()}
    assert set(got) == set(pages) and all(r.n_chars == len(r.text) for r in got.values())
    same = seen = 0
    for key, html in pages.items():
        html = html or ""
        if html.count("<article") != 1:
            continue
        inside = html[html.index("<article"):html.rfind("</article>")]
        if re.search(r"<(aside|nav|form|script|style|div|section|header|footer|svg|object)\b|class=", inside):
            continue
        plain = _Plain()
        plain.feed(html)
        seen += 1
        want = [" ".join("".join(b).split()) for b in plain.blocks]
        same += "\n\n".join(b for b in want if b) == got[key].text
    assert seen and same >= 0.95 * seen, (same, seen)
