"""The feature groups, by job name."""

from moontally.plans.groups import (
    arpu,
    bank_info,
    cdr,
    credit,
    handset,
    loans,
    package,
    postpaid,
    purchases,
    recharge,
    travel,
    user_info,
)

# In the column order of the feature store.
GROUPS = {
    group.name: group
    for group in (
        cdr.GROUP,
        recharge.GROUP,
        credit.GROUP,
        user_info.GROUP,
        travel.GROUP,
        loans.RECOVERY,
        loans.GROUP,
        purchases.EXTRAS,
        purchases.PURCHASES,
        postpaid.GROUP,
        bank_info.GROUP,
        handset.GROUP,
        package.GROUP,
        arpu.GROUP,
    )
}
