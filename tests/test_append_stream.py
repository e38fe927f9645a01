import datetime
import json
from pathlib import Path

from emploiscope import schemas
from emploiscope.plans.landing import ADZUNA_FIELDS, adzuna_rows
from emploiscope.sources.sink import INGESTION_DATE
from emploiscope.streaming.append import append_new_files


def land(root: Path, day: str, *ids: str) -> None:
    folder = root / day
    folder.mkdir(parents=True)
    records = ({"id": i, "title": "Data Engineer", "company": {"display_name": "Acme"}} for i in ids)
    (folder / "offers.jsonl").write_text("\n".join(map(json.dumps, records)), encoding="utf-8")


def test_each_landed_file_is_appended_once(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "adzuna", str(tmp_path / "raw"), str(tmp_path / "state")

    def run():
        append_new_files(
            spark, str(landing), ADZUNA_FIELDS, lambda df: adzuna_rows(df, [INGESTION_DATE]), target, checkpoint
        ).awaitTermination()
        return spark.read.parquet(target)

    land(landing, "2026-03-20", "1", "2")
    assert run().count() == 2
    assert run().count() == 2
    land(landing, "2026-03-27", "1")
    table = run()
    assert table.schema.simpleString() == schemas.ADZUNA.simpleString()
    got = sorted((r["offre_id"], r["entreprise_nom"], r[INGESTION_DATE]) for r in table.collect())
    first, second = datetime.date(2026, 3, 20), datetime.date(2026, 3, 27)
    assert got == [("1", "Acme", first), ("1", "Acme", second), ("2", "Acme", first)]
