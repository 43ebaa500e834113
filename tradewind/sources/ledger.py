"""Which stages of a run are finished, so that a run that lost its driver goes on where it stopped."""

import hashlib
import json
from collections.abc import Callable
from datetime import date
from typing import Any

from pyspark.sql import SparkSession

from tradewind.sources.folders import Folder


class Ledger:
    """An entry for each run date, input and stage, with what the stage reported.

    An entry is written after its stage's files stand and before the next stage begins. A stage that was cut short has
    none and runs again, which its keyed writes make harmless. An input is named by its caller: another name, another
    run."""

    def __init__(self, spark: SparkSession, root: str):
        self.folder = Folder(spark, f"{root}/ledger")

    @staticmethod
    def _name(as_of: date, input_id: str, stage: str) -> str:
        return f"{as_of.isoformat()}-{hashlib.sha256(input_id.encode()).hexdigest()[:32]}-{stage}.json"

    def finished(self, as_of: date, input_id: str, stage: str) -> Any:
        """What the stage reported; None if it is not finished."""
        entry = self.folder.read(self._name(as_of, input_id, stage))
        return None if entry is None else json.loads(entry)["report"]

    def once(self, as_of: date, input_id: str | None, stage: str, run: Callable[[], Any]) -> Any:
        """The stage's report, from its entry or by running it. Without a name of the input every stage runs."""
        if input_id is None:
            return run()
        report = self.finished(as_of, input_id, stage)
        if report is None:
            report = run()
            entry = {"as_of": as_of.isoformat(), "input": input_id, "stage": stage, "report": report}
            self.folder.replace(self._name(as_of, input_id, stage), json.dumps(entry))
        return report
