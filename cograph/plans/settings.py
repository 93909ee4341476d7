"""Parameter sets of the registered queries (one per input family)."""

from cograph.params import RecParams

# FX1 (customer -> part signals): p = 1, threshold 1.0, prior 4, 20 recs per item.
FX1 = RecParams(logistic_param=1.0, min_link_weight=1.0, prior=4.0, max_links_per_user=100,
                num_recs_per_item=20, initial_nhood_size=20, num_recs_per_user=10,
                diversity_adjust=False)
# FX2 (typed event signals): every pair of its 100 items is linked, and the sums
# grow with the table, so the threshold is a share of its rows: about the median link.
FX2_LINK_SHARE = 0.00189
FX2 = FX1.with_(min_link_weight=f"(SELECT count(*) * CAST({FX2_LINK_SHARE!r} AS DOUBLE) FROM events)")  # as the SQL twins see it


def fx2(rows: int) -> RecParams:
    return FX2.with_(min_link_weight=rows * FX2_LINK_SHARE)


# FX3 (event log): the application's own parameters.
FX3 = RecParams.application()

N2_NHOOD, N2_RECS = 5, 20      # neighbourhood pruning that leaves room for indirect recs
WIDE_NHOOD, WIDE_RECS = 60, 10  # a neighbourhood far larger than the list
N4_NHOOD = 5
TOP_K_QUERY = 10               # top_links_per_user
UNCAPPED_BLOCK = 16            # item_item_graph_uncapped: most users of FX1 have more items
BOT_THRESHOLD = 70             # remove_bots on FX2
SELECT_ITEMS = (1, 2)          # select_signals on FX2
QUALITY_Q, QUALITY_Y = 0.995, 0.9   # fit_logistic: 99.5 % quantile of quality -> 0.9
