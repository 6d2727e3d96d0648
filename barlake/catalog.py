"""Catalogue of the twelve market tables: schema, key, partitioning, tie-break order.

All dates are ``yyyyMMdd`` strings (lexicographic order is chronological order) and every
amount is a double.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column names of the tables, in their public order.
_STATEMENT_TEXT = """
    ts_code ann_date f_ann_date end_date report_type comp_type end_type update_flag
"""

_INCOME_NUM = """
    basic_eps diluted_eps total_revenue revenue int_income prem_earned comm_income
    n_commis_income n_oth_income n_oth_b_income prem_income out_prem une_prem_reser
    reins_income n_sec_tb_income n_sec_uw_income n_asset_mg_income oth_b_income
    fv_value_chg_gain invest_income ass_invest_income forex_gain total_cogs oper_cost
    int_exp comm_exp biz_tax_surchg sell_exp admin_exp fin_exp assets_impair_loss
    prem_refund compens_payout reser_insur_liab div_payt reins_exp oper_exp
    compens_payout_refu insur_reser_refu reins_cost_refund other_bus_cost operate_profit
    non_oper_income non_oper_exp nca_disploss total_profit income_tax n_income
    n_income_attr_p minority_gain oth_compr_income t_compr_income compr_inc_attr_p
    compr_inc_attr_m_s ebit ebitda insurance_exp undist_profit distable_profit rd_exp
    fin_exp_int_exp fin_exp_int_inc transfer_surplus_rese transfer_housing_imprest
    transfer_oth adj_lossgain withdra_legal_surplus withdra_legal_pubfund
    withdra_biz_devfund withdra_rese_fund withdra_oth_ersu workers_welfare
    distr_profit_shrhder prfshare_payable_dvd comshare_payable_dvd capit_comstock_div
    continued_net_profit
"""

_CASHFLOW_NUM = """
    net_profit finan_exp c_fr_sale_sg recp_tax_rends n_depos_incr_fi n_incr_loans_cb
    n_incr_borr_oth_fi prem_fr_orig_contr n_incr_insured_dep n_reinsur_prem
    n_incr_disp_tfa ifc_cash_incr n_incr_disp_faas n_incr_loans_oth_bank
    n_cap_incr_repur c_fr_oth_operate_a c_inf_fr_operate_a c_paid_goods_s
    c_paid_to_for_empl c_paid_for_taxes n_incr_clt_adv n_incr_dep_cbob
    c_pay_claims_orig_inco pay_handling_chrg pay_comm_insur_plcy oth_cash_pay_oper_act
    st_cash_out_act n_cashflow_act oth_recp_ral_inv_act c_disp_withdrwl_oth
    c_recp_return_equit n_recp_disp_fiolta stot_inflows_inv_act c_pay_acq_const_fiolta
    c_paid_invest n_disp_subs_oth_biz oth_pay_ral_inv_act n_incr_pledge_loan
    stot_out_inv_act n_cashflow_inv_act c_recp_borrow proc_issue_bonds
    oth_cash_recp_ral_fnc_act stot_cash_in_fnc_act free_cashflow c_prepay_amt_borr
    c_pay_dist_dpcp_int_exp incl_dvd_profit_paid_sc_ms oth_cashpay_ral_fnc_act
    stot_cashout_fnc_act n_cash_flows_fnc_act eff_fx_flu_cash n_incr_cash_cash_equ
    c_cash_equ_beg_period c_cash_equ_end_period c_recp_cap_contrib incl_cash_rec_saims
    unpaid_invest prov_depr_assets depr_fa_coga_dpba amort_intang_assets
    lt_amort_deferred_exp defer_tax_less_assets defer_tax_less_liab loss_disp_fiolta
    loss_scr_fa loss_fv_chg invest_loss decr_def_inc_tax_assets incr_def_inc_tax_liab
    decr_inventories decr_oper_payable incr_oper_payable others im_net_cashflow_oper_act
    conv_debt_into_cap conv_cop_debt_due_1y fa_fnc_leases end_bal_cash less_beg_bal_cash
    plus_end_bal_cash_equ less_beg_bal_cash_equ im_n_incr_cash_equ
"""

_BALANCE_NUM = """
    total_hldr_eqy_exc_min_int total_hldr_eqy_inc_min_int total_assets total_cur_assets
    total_nca total_liab total_cur_liab total_ncl money_cap trad_asset notes_receiv
    accounts_receiv oth_receiv prepayment div_receiv int_receiv inventories amor_exp
    nca_within_1y sett_rsrv loanto_oth_bank_fi premium_receiv reinsur_receiv
    reinsur_cont_res redem_meas_inv oth_cur_assets nca fin_assets_avail_for_sale
    htm_invest long_equity_invest invest_real_estate time_deposits oth_assets lt_rec
    fix_assets cip const_materials fixed_assets_disp intang_assets r_and_d_exp goodwill
    lt_amor_exp defer_tax_assets oth_nca st_borrow st_notes_payable accounts_payable
    adv_pepmts int_payable div_payable oth_payable accrued_exp deferred_inc
    lt_borr_due_within_1y sett_rsrv_payable deposit_received trad_liab notes_payable
    oth_cur_liab lt_borrow lt_notes_payable bonds_payable lt_payable
    specific_item_payable long_deferred_inc defer_tax_liab oth_ncl cap_rese surplus_rese
    undistort_profit minority_int
"""

_DAILY_NUM = "open high low close pre_close change pct_chg vol amount"
_INDEX_DAILY_NUM = "close open high low pre_close change pct_chg vol amount"
_MASTER_TEXT = """
    ts_code symbol name area industry fullname enname cnspell market exchange curr_type
    list_status list_date delist_date is_hs act_name act_ent_type
"""
_FLOW_NUM = """
    buy_sm_vol buy_sm_amount sell_sm_vol sell_sm_amount
    buy_md_vol buy_md_amount sell_md_vol sell_md_amount
    buy_lg_vol buy_lg_amount sell_lg_vol sell_lg_amount
    buy_elg_vol buy_elg_amount sell_elg_vol sell_elg_amount
    net_mf_vol net_mf_amount
"""

# The tracked indices and the short names their partitions carry.
TRACKED_INDICES = {
    "000852.SH": "zz1000",
    "932000.CSI": "zz2000",
    "000905.SH": "zz500",
    "000300.SH": "hs300",
}

# Index master markets that a refresh covers.
INDEX_MARKETS = ("CSI", "SSE", "SZSE")

HISTORY_YEARS = 15


def _schema(*groups: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, dtype, True) for names, dtype in groups for name in names.split()]
    )


_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


@dataclass(frozen=True)
class TableSpec:
    """What the engine knows about one table.

    ``derived`` maps a partition column that is not a data column to the rule that computes
    it; partition columns not listed there are data columns.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    code_col: str | None = None
    date_col: str | None = None
    partitions: tuple[str, ...] = ()
    derived: tuple[str, ...] = ()
    newest_first: tuple[str, ...] = field(default=())
    sort_cols: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def storage_schema(self) -> T.StructType:
        extra = [T.StructField(c, _S, True) for c in self.derived]
        return T.StructType(list(self.schema.fields) + extra)

    def partition_column(self, name: str) -> Column:
        """Expression of a partition column over the data columns."""
        if name == "ym":
            return F.substring(F.col(self.date_col), 1, 6)
        if name == "year":
            return F.substring(F.col(self.date_col), 1, 4)
        if name == "index_short":
            return index_short(F.col(self.code_col))
        return F.col(name)


def index_short(code: Column, indices: dict[str, str] | None = None) -> Column:
    """Short name of a tracked index; null for an unknown code."""
    indices = TRACKED_INDICES if indices is None else indices
    out = F.lit(None).cast("string")
    for index_code, short in indices.items():
        out = F.when(code == index_code, F.lit(short)).otherwise(out)
    return out


_REVISION = ("f_ann_date", "ann_date", "update_flag", "report_type")


def _statement(name: str, numbers: str) -> TableSpec:
    return TableSpec(
        name, _schema((_STATEMENT_TEXT, _S), (numbers, _D)), ("ts_code", "end_date"),
        "ts_code", "end_date", ("end_date",), (), _REVISION, ("ts_code", "end_date"),
    )


def _by_month(name: str, numbers: str) -> TableSpec:
    return TableSpec(
        name, _schema(("ts_code trade_date", _S), (numbers, _D)), ("ts_code", "trade_date"),
        "ts_code", "trade_date", ("ym",), ("ym",), (), ("ts_code", "trade_date"),
    )


CATALOG: dict[str, TableSpec] = {
    s.name: s
    for s in (
        _by_month("daily", _DAILY_NUM),
        TableSpec("stock_basic", _schema((_MASTER_TEXT, _S)), ("ts_code",), "ts_code",
                  sort_cols=("ts_code",)),
        _statement("income", _INCOME_NUM),
        _statement("cashflow", _CASHFLOW_NUM),
        _statement("balancesheet", _BALANCE_NUM),
        TableSpec(
            "trade_calendar",
            _schema(("exchange cal_date", _S), ("is_open", _I), ("pretrade_date", _S)),
            ("exchange", "cal_date"), "exchange", "cal_date", ("year",), ("year",), (),
            ("cal_date", "exchange"),
        ),
        TableSpec("st_stocks", _schema(("ts_code symbol name st_type industry list_date", _S)),
                  ("ts_code",), "ts_code", sort_cols=("ts_code",)),
        _by_month("adjfactor", "adj_factor"),
        _by_month("moneyflow", _FLOW_NUM),
        # market is part of the key: one code may be listed in two markets.
        TableSpec(
            "index_basic",
            _schema(
                ("ts_code name fullname market publisher index_type category base_date", _S),
                ("base_point", _D), ("list_date weight_rule desc exp_date", _S),
            ),
            ("ts_code", "market"), "ts_code", None, ("market",), (), (), ("ts_code",),
        ),
        TableSpec(
            "index_weight",
            _schema(("index_code con_code trade_date", _S), ("weight", _D)),
            ("index_code", "con_code", "trade_date"), "index_code", "trade_date",
            ("index_short", "year"), ("index_short", "year"), (),
            ("index_code", "trade_date", "con_code"),
        ),
        TableSpec(
            "index_daily",
            _schema(("ts_code trade_date", _S), (_INDEX_DAILY_NUM, _D)),
            ("ts_code", "trade_date"), "ts_code", "trade_date",
            ("index_short", "year"), ("index_short", "year"), (), ("ts_code", "trade_date"),
        ),
    )
}

STATEMENTS = ("income", "cashflow", "balancesheet")
INDEX_TABLES = ("index_weight", "index_daily")


def spec_of(table: str | TableSpec) -> TableSpec:
    return table if isinstance(table, TableSpec) else CATALOG[table]
