import pytest

from millrace.operators import evaluation, routing

# stored results of ten categories: (category, baseline, lstm, gbm, gbm mase, lstm mase, gbm skill, lstm skill)
SCORES = [
    ("auto", 17.20800605880342, 19.65834172566732, 15.793595790526696, 4.023488381436865, 4.661957820256551, 17.335444157132983, -2.892852746697493),
    ("bed_bath_table", 13.825843619227465, 19.837555567423504, 17.41320871165453, 3.832696333679344, 4.0330015023549395, 9.818382841824217, -2.7371317423144528),
    ("computers_accessories", 17.67613607327708, 20.61850929260254, 16.027307414968828, 2.590860221432022, 3.184000333150228, 19.96721656058598, -2.9590775736371566),
    ("furniture_decor", 18.081642635178778, 20.25237687428792, 18.137633495572025, 2.926864056647485, 3.006417671839396, 6.899696128934077, -3.9552606664519567),
    ("garden_tools", 27.753372849594115, 24.989413897196453, 23.28018317219137, 2.0010751297157525, 2.2342096964518228, 0.6542746606588897, -6.639693871107415),
    ("health_beauty", 12.877188621793067, 19.136351267496742, 17.633814223449146, 7.106673679145163, 6.945512771606445, 4.342679269938645, -3.808057747298764),
    ("housewares", 13.785465980526972, 21.271578788757324, 18.7825062140515, 5.173190412185016, 5.22989543279012, 9.861389581687618, -2.0838533350405695),
    ("sports_leisure", 17.55310645238958, 19.13680426279704, 15.244446534961003, 2.8693109587742676, 3.443453232447306, 18.455833657287258, -2.3648036721781525),
    ("telephony", 31.173773790314403, 21.08113670349121, 26.961057187353152, 4.134734272456494, 3.288879632949829, -32.21242665849717, -3.3782995388021932),
    ("watches_gifts", 21.72414518911293, 18.40096632639567, 16.2834027301251, 3.831068119069229, 4.356205304463704, 6.992870278422007, -5.1021915214668105),
]
NOISE = 5.15250424695116


@pytest.fixture(scope="module")
def results(spark):
    rows = []
    for c, base, lstm, gbm, gm, lm, gs, ls in SCORES:
        rows += [("baseline", c, base, None, None, None), ("lstm", c, lstm, lm, ls, None), ("gbm", c, gbm, gm, gs, NOISE)]
    return spark.createDataFrame(
        rows, "model string, category string, mape double, mase double, forecast_skill_pct double, noise_threshold_pp double"
    )


def test_model_leaderboard(results):
    got = [tuple(r) for r in routing.model_leaderboard(results).orderBy("rank").collect()]
    want = [
        (1, "gbm", 18.555715547485335, 17.523511467551838, 10, 3.848996156454164, 6.211536047797451),
        (2, "baseline", 19.16586812702178, 17.61462126283333, 10, None, None),
        (3, "lstm", 20.438303470611572, 20.044966220855713, 10, 4.038353339831035, -3.5921222414994967),
    ]
    for a, b in zip(got, want):
        assert a[:2] == b[:2] and a[4] == b[4]
        assert a[2:4] == pytest.approx(b[2:4], abs=1e-9)
        assert (a[5:] == b[5:]) or a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_category_leaderboard_and_selection(results):
    board = routing.category_leaderboard(results)
    rows = {r["category"]: r for r in board.collect()}
    assert {c for c, r in rows.items() if r["margin_is_genuine"]} == {"telephony"}
    assert rows["telephony"]["best_model"] == "lstm"
    assert rows["auto"]["best_model"] == "no_clear_winner"
    assert rows["telephony"]["margin_pp"] == pytest.approx(5.879920483861941)
    assert rows["telephony"]["margin_pct"] == pytest.approx(21.808938881744165)
    assert rows["housewares"]["margin_pct"] == pytest.approx(26.604757515193377)
    assert rows["auto"]["threshold_source"] == "gbm_cv"
    chosen = {r["category"]: r for r in routing.model_selection(board, routing.model_leaderboard(results)).collect()}
    assert {c: r["selected_model"] for c, r in chosen.items()} == {c[0]: "lstm" if c[0] == "telephony" else "gbm" for c in SCORES}
    assert chosen["telephony"]["confidence"] == "high" and chosen["auto"]["confidence"] == "low"


def test_mean_skill(results):
    tables = evaluation.skill_tables(routing.category_leaderboard(results))
    means = {r["comparison"]: r["avg_pct"] for r in evaluation.skill_summary(tables).collect()}
    assert means["gbm_vs_baseline"] == pytest.approx(-1.4, abs=0.05)
    assert means["lstm_vs_baseline"] == pytest.approx(-14.1, abs=0.05)
    assert means["gbm_vs_lstm"] == pytest.approx(9.5, abs=0.05)


def test_missing_results(spark):
    rows = [("lstm", "only", 9.0, None), ("gbm", "two", 8.0, None), ("baseline", "two", 20.0, None), ("gbm", "none", None, None)]
    frame = spark.createDataFrame(rows, "model string, category string, mape double, noise_threshold_pp double")
    got = {r["category"]: r for r in routing.category_leaderboard(frame).collect()}
    assert got["only"]["best_model"] == "lstm" and not got["only"]["margin_is_genuine"]
    assert got["two"]["best_model"] == "gbm" and got["two"]["noise_threshold_pp"] == 1.5
    assert got["none"]["best_model"] == "insufficient_data"


def test_resolve(spark, results):
    board = routing.model_leaderboard(results)
    selection = routing.model_selection(routing.category_leaderboard(results), board)
    asked = spark.createDataFrame(
        [("telephony", None), ("telephony", " LSTM"), ("new", "auto"), ("auto", "xgb")], "category string, requested string"
    )
    got = {(r["category"], r["requested"]): r for r in routing.resolve_model(asked, selection, routing.global_default(board)).collect()}
    assert got["telephony", "auto"]["model"] == "lstm" and got["telephony", "auto"]["confidence"] == "high"
    assert got["telephony", "lstm"]["confidence"] == "unknown" and not got["telephony", "lstm"]["was_auto"]
    assert got["new", "auto"]["model"] == "gbm" and got["new", "auto"]["confidence"] == "low" and not got["new", "auto"]["known"]
    assert got["auto", "xgb"]["model"] is None and got["auto", "xgb"]["error"]


def test_results_filter(spark):
    frame = spark.createDataFrame([("a", "global"), ("b", "single")], "category string, mode string")
    assert [r[0] for r in routing.results_filter(frame).collect()] == ["a"]
    assert routing.results_filter(frame.filter("mode = 'single'")).count() == 1
