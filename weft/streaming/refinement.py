"""The refinement loop as a stateful stream.

The loop of L1 waits for a whole round of answers. Where answers come back one by
one (a queue in front of a model), each prompt goes on by itself: its state holds
the initial prompt, the round it waits for, the last answer and answers that came
early. Events may come in any order and more than once; the outcome is that of
the batch loop. A prompt without news for ``patience`` is given up with its
last answer. State and timers live in the query's checkpoint, so a restarted
query goes on where it stopped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weft.functions import prompts as R
from weft.operators.completion import Rule, judge
from weft.session import ship_package

#: Input: a prompt (``kind`` 'prompt', its text) or the answer to a round of it.
EVENTS = "prompt_id long, kind string, iteration int, text string, ts timestamp"
#: Output: 'ask' rows hold the prompt of the next round; 'accepted', 'exhausted' (the
#: bound was reached) and 'abandoned' rows are final.
OUTCOMES = "prompt_id long, status string, iteration int, prompt string, response string, accepted boolean"
_STATE = "initial string, pending int, response string, early string, done boolean"


class _Prompt:
    """One prompt's progress and the rows it gives."""

    def __init__(self, prompt_id: int, bound: int, saved: tuple | None):
        self.id, self.bound, self.rows = prompt_id, bound, []
        initial, self.pending, self.response, early, self.done = saved or (None, 0, None, "{}", False)
        self.initial, self.early = initial, json.loads(early)

    def saved(self) -> tuple:
        return self.initial, self.pending, self.response, json.dumps(self.early), self.done

    def _row(self, status: str, prompt: str | None, accepted: bool | None) -> None:
        self.rows.append((self.id, status, self.pending, prompt, self.response, accepted))

    def begin(self, text: str) -> None:
        if self.initial is None:
            self.initial, self.pending = text, 1
            self._row("ask", text, None)

    def answer(self, iteration: int, text: str, accepted: bool, instructions: str | None) -> None:
        if not self.done and iteration >= max(self.pending, 1):
            self.early.setdefault(str(iteration), [text, accepted, instructions])

    def go_on(self) -> None:
        """Take the answers there are, round by round."""
        while not self.done and (found := self.early.pop(str(self.pending), None)) is not None:
            self.response, accepted, instructions = found
            if accepted or self.pending >= self.bound:
                self.done, self.early = True, {}
                self._row("accepted" if accepted else "exhausted", None, accepted)
            else:
                self.pending += 1
                retry = R.RETRY_1 + self.initial + R.RETRY_2 + (self.response or "") + R.RETRY_3 + (instructions or "")
                self._row("ask", retry, None)

    def give_up(self) -> None:
        if not self.done:
            self.done = True
            self._row("abandoned", None, False)


def refine_stream(events: DataFrame, rule: Rule, max_interactions: int = 10, patience: str = "1 hour", disorder: str = "10 minutes") -> DataFrame:
    """``OUTCOMES`` of a stream of ``EVENTS``: answers are judged by ``rule`` (a column
    expression), the loop of each prompt goes on at most ``max_interactions`` rounds.
    Events later than ``disorder`` behind the newest may be lost; a prompt
    without events for ``patience`` after its last is given up."""
    if max_interactions < 1:
        raise ValueError("max_interactions must be >= 1")
    if not events.isStreaming:
        raise ValueError("refine_stream expects a streaming DataFrame; use refine for tables")
    ship_package(events.sparkSession)
    wait = pd.Timedelta(patience) // pd.Timedelta("1ms")
    columns = [c.split()[0] for c in OUTCOMES.split(", ")]

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prompt = _Prompt(int(key[0]), max_interactions, state.get if state.exists else None)
        if state.hasTimedOut:
            prompt.give_up()
            state.remove()
        else:
            newest = 0
            for frame in frames:
                newest = max(newest, int(frame["ts"].max().value // 1_000_000))
                for kind, iteration, text, accepted, instructions in zip(frame["kind"], frame["iteration"], frame["text"], frame["accepted"], frame["instructions"]):
                    if kind == "prompt":
                        prompt.begin(text or "")
                    else:
                        prompt.answer(int(iteration), text, bool(accepted), instructions)
            prompt.go_on()
            state.update(prompt.saved())
            state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + max(1, wait))
        if prompt.rows:
            yield pd.DataFrame(prompt.rows, columns=columns)

    judged = judge(events.withWatermark("ts", disorder), rule, "text")
    judged = judged.select("prompt_id", "kind", F.coalesce("iteration", F.lit(0)).alias("iteration"), "text", "accepted", "instructions", "ts")
    return judged.groupBy("prompt_id").applyInPandasWithState(step, OUTCOMES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
