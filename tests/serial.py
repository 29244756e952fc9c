"""Plain serial runs that the distributed operators must agree with."""

from __future__ import annotations


def guarded_debits(balances, debits):
    """balances {account: amount}, debits [(seq, account, amount)] -> {seq: outcome}"""
    left, result = dict(balances), {}
    for seq, account, amount in sorted(debits):
        if amount is None or amount <= 0:
            result[seq] = "INVALID"
        elif account not in left:
            result[seq] = "NOT_FOUND"
        elif left[account] >= amount:
            left[account] -= amount
            result[seq] = "APPLIED"
        else:
            result[seq] = "REJECTED"
    return result


def blank(text):
    return text is None or not text.strip() or len(text) > 128


def transfers(accounts, stored, requests):
    """accounts {id: (currency, balance)}, stored {key: (id, payload)}, requests [(seq, key, from, to, amount, actor)]

    -> {seq: (outcome, seq or stored id of the transfer it stands for)}, balances
    """
    balance = {a: b for a, (_, b) in accounts.items()}
    known = {k: (("stored", i), p) for k, (i, p) in stored.items()}
    result = {}
    for seq, key, src, dst, amount, actor in sorted(requests, key=lambda r: r[0]):
        payload = (src, dst, amount)
        if blank(key) or blank(actor) or amount is None or amount <= 0 or src == dst:
            result[seq] = ("INVALID_REQUEST", None)
        elif key in known:
            same = known[key][1] == payload
            result[seq] = ("REPLAY", known[key][0]) if same else ("INVALID_REQUEST", None)
        elif src not in accounts or dst not in accounts or accounts[src][0] != accounts[dst][0]:
            result[seq] = ("OPERATION_REJECTED", None)
        elif balance[src] < amount:
            result[seq] = ("OPERATION_REJECTED", None)
        else:
            balance[src] -= amount
            balance[dst] += amount
            known[key] = (("seq", seq), payload)
            result[seq] = ("COMPLETED", ("seq", seq))
    return result, balance


def optimistic(versions, commands):
    """versions {row: version}, commands [(seq, row, expected or None)] -> {seq: (outcome, version)}"""
    current, result = dict(versions), {}
    for seq, row, expected in sorted(commands, key=lambda c: c[0]):
        if expected is None:
            current[row] = current.get(row, -1) + 1
            result[seq] = ("APPLIED", current[row])
        elif row not in current:
            result[seq] = ("NOT_FOUND", None)
        elif current[row] != expected:
            result[seq] = ("STALE", current[row])
        else:
            current[row] += 1
            result[seq] = ("APPLIED", current[row])
    return result


def operations(attempts):
    """attempts [(seq, key, amount, gateway)] -> {seq: (outcome, status)}"""
    stored, result = {}, {}
    for seq, key, amount, gateway in sorted(attempts, key=lambda a: a[0]):
        if not key.strip() or amount <= 0:
            result[seq] = ("INVALID", None)
            continue
        if key in stored and stored[key][0] != amount:
            result[seq] = ("REJECTED", None)
            continue
        if key in stored and stored[key][1] == "COMPLETED":
            result[seq] = ("REPLAY", "COMPLETED")
            continue
        status, outcome = {
            "OK": ("COMPLETED", "CHARGED"), "ERROR": ("FAILED", "GATEWAY_ERROR"), "TIMEOUT": ("RESERVED", "UNKNOWN")
        }[gateway]
        stored[key] = (amount, status)
        result[seq] = (outcome, status)
    return result
