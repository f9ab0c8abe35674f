"""Texts that notes refer to, against a plain walk of each document."""

from __future__ import annotations

import random
import xml.etree.ElementTree as ElementTree

from pyspark.sql import functions as F

from carestitch.sources import ccda


def plain(document: str, wanted: list[str]) -> dict[str, str]:
    """Text of each wanted ID that has any: contents first, a line for each run of characters."""
    found: dict[tuple[str, str], str] = {}
    for element in ElementTree.fromstring(document.encode()).iter():
        kind, own = element.tag.rpartition("}")[2], element.get("ID")
        if kind in ("content", "paragraph") and own in wanted:
            found[kind, own] = found.get((kind, own), "") + "".join(f"{t}\n" for t in element.itertext() if t)
    texts = {w: found.get(("content", w), "") + found.get(("paragraph", w), "") for w in wanted}
    return {w: t for w, t in texts.items() if t}


def check(spark, documents: list[tuple[str, list[str]]]) -> None:
    rows = [(f"/d/{i}.xml", xml, wanted) for i, (xml, wanted) in enumerate(documents)]
    df = spark.createDataFrame(rows, "path string, xml string, wanted array<string>").repartition(3)
    got = {(r.path, r.reference): r.narrative for r in ccda.narrative(df).collect()}
    assert got == {(path, w): t for path, xml, wanted in rows for w, t in plain(xml, wanted).items()}


def test_nested_elements_prefixes_and_repeated_ids(spark):
    check(spark, [
        ('<a xmlns="urn:x">out<paragraph ID="1">one <content ID="2">two</content> three</paragraph><content ID="2">again</content></a>', ["1", "2", "none"]),
        ('<x:a xmlns:x="urn:x"><x:content ID="1">a<x:content ID="2">b<x:paragraph ID="1">c</x:paragraph></x:content>d</x:content></x:a>', ["1", "2"]),
        ('<a><content ID="1"/><content>no id</content><content ID="2"></content><contents ID="1">other</contents><content ID="3">x<content/>y</content></a>', ["1", "2", "3"]),
        ("<a><content ID='1'>single</content><content title=\" ID='4' > \" ID = \"5\">five</content></a>", ["1", "4", "5"]),
        ('<a><content ID="1">not asked for</content></a>', []),
        ("<a/>", ["1"]),
    ])


def test_references_comments_and_line_ends(spark):
    check(spark, [
        ('<?xml version="1.0"?><!-- <content ID="1">no</content> --><a><content ID="1">a &amp; b &lt;c&gt; &#233;&#xE9; &quot;&apos;</content></a>', ["1"]),
        ('<a><content ID="1">a<!-- x > <b> -->b<![CDATA[<i>&amp;</i>]]>c<?do it?>d</content></a>', ["1"]),
        ('<a><content ID="1">one\r\ntwo\rthree\n</content><content ID="a&amp;b">&amp;amp;</content></a>', ["1", "a&b"]),
        ('<a><content ID="1">  \n <b> </b></content><content ID="2"><!-- nothing --></content></a>', ["1", "2"]),
    ])


def test_random_documents(spark):
    draw = random.Random(7)

    def element(depth: int) -> str:
        tag = draw.choice(["content", "paragraph", "td", "list"])
        own = f' ID="{draw.randrange(6)}"' if draw.random() < 0.6 else ""
        inside = "".join(element(depth + 1) if depth < 6 and draw.random() < 0.5 else draw.choice(["", "text ", "&amp;", "<!-- c -->", "é", "\n"])
                         for _ in range(draw.randrange(5)))
        return f"<{tag}{own}>{inside}</{tag}>"

    check(spark, [(f'<doc xmlns="urn:hl7-org:v3">{"".join(element(0) for _ in range(6))}</doc>', [str(i) for i in range(draw.randrange(6))])
                  for _ in range(60)])


def test_a_long_document(spark):
    text = "word &amp; word " * 200_000
    check(spark, [(f'<a><content ID="1">{text}</content>{"<content ID=" + chr(34) + "2" + chr(34) + ">x</content>"}{"<td>y</td>" * 20_000}</a>', ["1", "2"])])


def test_no_rows(spark):
    none = spark.createDataFrame([], "path string, xml string, wanted array<string>")
    assert ccda.narrative(none).collect() == []


def test_notes_need_no_python(spark):
    act = ('<entry><act><code code="34109-9" codeSystem="2.16.840.1.113883.6.1"/><text>{}</text></act></entry>')
    xml = ('<ClinicalDocument xmlns="urn:hl7-org:v3"><component><structuredBody><component><section><text><content ID="n">read me</content></text>'
           + act.format('<reference value="#n"/>') + act.format('<reference value="#gone"/>') + act.format("") + "</section></component></structuredBody></component></ClinicalDocument>")
    documents = ccda.with_person(spark.createDataFrame([("/p/a.xml", xml)], "path string, xml string"), "salt")
    notes = ccda.notes(ccda.parse_documents(documents)).select("s_id", "s_note_text")
    assert sorted(notes.collect()) == [("0_cda/p/a.xml", "read me\n"), ("1_cda/p/a.xml", ""), ("2_cda/p/a.xml", None)]
    assert "Python" not in notes._jdf.queryExecution().executedPlan().toString()
    assert notes.filter(F.col("s_note_text") == "").count() == 1


def test_tags_of_other_elements_make_no_rows(spark):
    """A document's many other tags go before the tokens become rows."""
    xml = "<a>" + "<b c='1'><d/></b>" * 500 + '<content ID="1">kept<e/> whole</content></a>'
    df = spark.createDataFrame([("/d/0.xml", xml, ["1"])], "path string, xml string, wanted array<string>")
    found = ccda.narrative(df)
    assert [(r.reference, r.narrative) for r in found.collect()] == [("1", "kept\n whole\n")]
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "inline(filter(" in plan
