"""Parameters of the recommenders (one frozen dataclass, as SURVEY §2.15)."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class RecParams:
    """Tuning knobs of the recommenders.

    ``generic()`` holds the library defaults, ``application()`` the values the
    event-log application uses.
    """

    logistic_param: float = 2.0          # diminishing returns of repeated signals
    min_link_weight: float = 1.0         # item and link threshold
    prior: float = 4.0                   # Bayesian prior (pseudo observations)
    max_links_per_user: int | None = 100  # each user's strongest links that are paired; None: all
    num_recs_per_item: int = 20          # item-item list length
    initial_nhood_size: int | None = 20  # nearest links kept before the two-hop search; None: all
    num_recs_per_user: int = 10          # user list length
    diversity_adjust: bool = False       # reason-diversity re-weighting
    quality_logistic_param: float = 0.00227
    max_activity_considered: float = 64.0

    @staticmethod
    def generic() -> "RecParams":
        return RecParams()

    @staticmethod
    def application() -> "RecParams":
        return RecParams(
            logistic_param=1.0,
            min_link_weight=1.25,
            prior=7.39,
            max_links_per_user=100,
            num_recs_per_item=20,
            initial_nhood_size=20,
            num_recs_per_user=20,
            diversity_adjust=True,
        )

    def with_(self, **kw) -> "RecParams":
        return replace(self, **kw)
