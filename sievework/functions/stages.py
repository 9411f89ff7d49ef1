"""The two evaluation stages: which questions they ask, what an answer is worth, how columns are named."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Question:
    field: str
    """Name in the JSON reply."""
    column: str
    """Name in the results."""
    points: int


@dataclass(frozen=True)
class Stage:
    prefix: str
    gates: tuple[Question, ...]
    """Without all of these the score is 0."""
    extras: tuple[Question, ...]
    has_title: bool = False

    @property
    def questions(self) -> tuple[Question, ...]:
        return self.gates + self.extras

    @property
    def score_column(self) -> str:
        return f"{self.prefix}_score"

    @property
    def error_column(self) -> str:
        return f"{self.prefix}_error"

    @property
    def title_column(self) -> str:
        return f"{self.prefix}_title"

    @property
    def reasoning_column(self) -> str:
        return f"{self.prefix}_reasoning"

    @property
    def result_columns(self) -> list[str]:
        """Columns a stage adds to the output, in order."""
        title = [self.title_column] if self.has_title else []
        return [q.column for q in self.questions] + title + [self.score_column, self.error_column]


# Question fields, output columns and points.
WEBSITE = Stage(
    prefix="s1",
    gates=(
        Question("q1_sells_payments", "s1_sells_payments", 4),
        Question("q2_is_independent_iso", "s1_is_independent_iso", 2),
    ),
    extras=(
        Question("q3_zero_cost_pricing", "s1_zero_cost_pricing", 1),
        Question("q4_value_added_products", "s1_value_added_products", 1),
        Question("q5_has_agent_program", "s1_has_agent_program", 2),
    ),
)
PERSON = Stage(
    prefix="s2",
    gates=(
        Question("q1_person_sells_payments", "s2_person_sells_payments", 4),
        Question("q2_person_at_independent_iso", "s2_person_at_independent_iso", 2),
    ),
    extras=(
        Question("q3_person_is_decision_maker", "s2_person_is_decision_maker", 2),
        Question("q4_person_has_payments_experience", "s2_person_has_payments_experience", 1),
        Question("q5_person_manages_team", "s2_person_manages_team", 1),
    ),
    has_title=True,
)
