"""The example of the README runs as written."""

from __future__ import annotations

from pathlib import Path

from docmart.plans.pipeline import convert_table

CHART = """<ClinicalDocument>
  <recordTarget><patientRole><id extension="42"/></patientRole></recordTarget>
  <component><structuredBody><component><section><code code="8716-3"/>
    <entry><organizer><effectiveTime value="20240102"/>
      <component><observation><code code="8480-6" codeSystem="LN"/><value value="120"/></observation></component>
    </organizer></entry>
  </section></component></structuredBody></component>
</ClinicalDocument>"""


def test_example(spark):
    readme = (Path(__file__).parent.parent / "README.md").read_text()
    example = readme.split("```python\n")[1].split("```")[0]
    names: dict = {}
    exec(example, names)  # noqa: S102 - the repository's own text
    corpus = spark.createDataFrame([("a.xml", CHART)], "file_name string, xml string")
    codes = spark.createDataFrame([("LN", "8480-6", 7)], "code_system string, code string, concept_id bigint")
    row = convert_table(corpus, "measurement", [names["VITALS"]], names["ROUTING"], codes).first()
    assert (row["person_id"], str(row["taken_on"]), row["value"], row["concept_id"]) == (42, "2024-01-02", 120.0, 7)
