"""Sequential pure-Python replays used as test oracles (small inputs only)."""

from __future__ import annotations

import hashlib
import json


def git_id(kind: bytes, body: bytes) -> str:
    return hashlib.sha1(kind + b" " + str(len(body)).encode() + b"\x00" + body).hexdigest()


def tree_id(entries: dict[str, tuple[int, str, bool]]) -> str:
    """entries: name -> (perms, hex id, is_dir)."""
    def key(item):
        name, (_, _, is_dir) = item
        return (name + "/" if is_dir else name).encode()
    body = b"".join(b"%o %s\x00" % (perms, name.encode()) + bytes.fromhex(h)
                    for name, (perms, h, _) in sorted(entries.items(), key=key))
    return git_id(b"tree", body)


def stamp(ts) -> str:
    import calendar
    secs = calendar.timegm(ts.timetuple())
    us = ts.microsecond
    return str(secs) if us == 0 else f"{secs}.{us:06d}".rstrip("0")


def revision_id(tree, parent, author, ts, uuid, rev, message) -> str:
    s = stamp(ts)
    body = f"tree {tree}\n" + (f"parent {parent}\n" if parent else "")
    body += f"author {author} {s} +0000\ncommitter {author} {s} +0000\n"
    body += f"svn_repo_uuid {uuid}\nsvn_revision {rev}\n\n{message}"
    return git_id(b"commit", body.encode())


def snapshot_head(revision_hex: str) -> str:
    body = b"revision HEAD\x00" + b"20:" + bytes.fromhex(revision_hex)
    return git_id(b"snapshot", body)


def uuid_of(origin: str) -> str:
    m = hashlib.md5(origin.encode()).hexdigest()
    return "-".join([m[0:8], m[8:12], m[12:16], m[16:20], m[20:32]])


def replay_events(pdf):
    """Adapter E replayed sequentially.  Returns {origin: [(rev, tree, revid)]}."""
    out = {}
    for user, g in pdf.sort_values(["user_id", "ts", "event_id"]).groupby("user_id"):
        origin = f"u{user}"
        uuid = uuid_of(origin)
        dirs: dict[str, dict[str, str]] = {}
        parent = None
        rows = []
        for rev, r in enumerate(g.itertuples(index=False), start=1):
            k = json.loads(r.props)["k"]
            d, f = f"d{k // 10}", f"f{k}"
            if r.event_type == "error":
                if d in dirs:
                    dirs[d].pop(f, None)
            elif r.event_type == "signup" and k % 10 == 0:
                dirs.pop(d, None)
            else:
                data = f"{r.event_type} {r.event_id}".encode()
                dirs.setdefault(d, {})[f] = git_id(b"blob", data)
            root = {dn: (0o40000, tree_id({fn: (0o100644, b, False) for fn, b in fs.items()}), True)
                    for dn, fs in dirs.items()}
            t = tree_id(root)
            parent = revision_id(t, parent, r.event_type, r.ts, uuid, rev, f"event {r.event_id}")
            rows.append((rev, t, parent))
        out[origin] = rows
    return out


def replay_orders(orders, lineitem):
    """Adapter O replayed sequentially: {origin: [(rev, tree, files)]}."""
    li = lineitem.sort_values(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                               "l_extendedprice"]).copy()
    li["line"] = li.groupby("l_orderkey").cumcount() + 1
    by_order = {k: g for k, g in li.groupby("l_orderkey")}
    out = {}
    for cust, g in orders.sort_values(["o_custkey", "o_orderdate", "o_orderkey"]).groupby("o_custkey"):
        files: dict[str, str] = {}
        hist = []
        for rev, o in enumerate(g.itertuples(index=False), start=1):
            lines = by_order.get(o.o_orderkey)
            before = dict(files)
            if lines is not None:
                first = lines[lines.line == 1]
                if o.o_orderstatus == "F" and rev > 1 and len(first):
                    src = f"p{int(first.l_partkey.iloc[0]) % 50}"
                    dst = f"tags/o{o.o_orderkey}"
                    for pth in [p for p in files if p == dst or p.startswith(dst + "/")]:
                        del files[pth]
                    for pth, b in before.items():
                        if pth.startswith(src + "/"):
                            files[dst + pth[len(src):]] = b
                for r in lines.itertuples(index=False):
                    data = f"{r.l_orderkey}:{r.l_partkey}:{r.l_suppkey}".encode()
                    files[f"p{r.l_partkey % 50}/{r.l_returnflag}/{r.line}"] = git_id(b"blob", data)
            hist.append((rev, nested_tree_id(files), dict(files)))
        out[f"c{cust}"] = hist
    return out


def nested_tree_id(files: dict[str, str]) -> str:
    """Tree id of a flat {path: blob} map (directories implied)."""
    tree: dict = {}
    for path, b in files.items():
        parts = path.split("/")
        node = tree
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = b

    def rec(node) -> str:
        entries = {}
        for name, v in node.items():
            if isinstance(v, dict):
                entries[name] = (0o40000, rec(v), True)
            else:
                entries[name] = (0o100644, v, False)
        return tree_id(entries)
    return rec(tree)


def listing_tree_id(files: dict[str, str], dirs: set[str]) -> str:
    tree: dict = {}
    for d in dirs:
        node = tree
        for p in d.split("/"):
            node = node.setdefault(p, {})
    for path, b in files.items():
        parts = path.split("/")
        node = tree
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = b

    def rec(node) -> str:
        return tree_id({name: ((0o40000, rec(v), True) if isinstance(v, dict) else (0o100644, v, False))
                        for name, v in node.items()})
    return rec(tree)


# ---------------------------------------------------------------- general logs

def replay_log(changes, props):
    """One origin's change rows (rev, seq, path, kind, action, copyfrom_path,
    copyfrom_rev, blob) and property events (rev, path, name, value) replayed
    in order.  Returns {rev: {path: [kind, blob, {name: value}, life]}}, life
    being (path, birth revision, (source path, revision) or None).  The root
    is '' where it has properties."""
    def below(top):
        return lambda p: top == "" or p == top or p.startswith(top + "/")

    nodes, states, root = {}, {0: {}}, ["dir", None, {}, ("", 0, None)]
    for rev in range(1, max(r[0] for r in changes) + 1):
        for _, _, path, kind, action, src, src_rev, blob in sorted((c for c in changes if c[0] == rev), key=lambda c: c[1]):
            if action == "delete" or action == "copy":
                nodes = {p: n for p, n in nodes.items() if not below(path)(p)}
            if action == "delete":
                continue
            parts = path.split("/")
            for i in range(1, len(parts)):
                p = "/".join(parts[:i])
                nodes.setdefault(p, ["dir", None, {}, (p, rev, None)])
            if action == "copy":
                if src == "":
                    nodes[path] = ["dir", None, dict(states[src_rev].get("", root)[2]), (path, rev, ("", src_rev))]
                for p, (k, b, own, _) in states[src_rev].items():
                    if below(src)(p) and p != "":
                        to = path + ("/" + p if src == "" else p[len(src):])
                        nodes[to] = [k, b, dict(own), (to, rev, (p, src_rev))]
            else:
                old = nodes.get(path)
                nodes[path] = [kind, blob, *(old[2:] if old and old[0] == kind else ({}, (path, rev, None)))]
        for _, path, name, value in (e for e in props if e[0] == rev):
            node = root if path == "" else nodes.get(path)
            if node is not None:
                if value is None:
                    node[2].pop(name, None)
                else:
                    node[2][name] = value
        states[rev] = {p: [k, b, dict(own), life] for p, (k, b, own, life) in [*nodes.items(), *([("", root)] if root[2] else [])]}
    return states


def exported(data: str, props: dict) -> tuple[int, str]:
    """(mode, id) of a file as an export writes it."""
    import re
    if "svn:special" in props and data.startswith("link "):
        return 0o120000, git_id(b"blob", data[5:].encode())
    ending = {"native": "\n", "LF": "\n", "CRLF": "\r\n", "CR": "\r"}.get(props.get("svn:eol-style"))
    if ending:
        data = re.sub("\r\n|\r|\n", ending, data)
    return 0o100755 if "svn:executable" in props else 0o100644, git_id(b"blob", data.encode())


def state_tree_id(nodes: dict, data: dict | None = None) -> str:
    """Root tree id of a state of ``replay_log``; ``data`` maps blobs to
    contents, which are then exported, else ids are as they are."""
    nodes = {p: n for p, n in nodes.items() if p != ""}
    entries = {"": {}}
    for p, n in nodes.items():
        if n[0] == "dir":
            entries[p] = {}
    for p in sorted(nodes, key=lambda p: -p.count("/")):
        kind, blob, props = nodes[p][:3]
        up, _, name = p.rpartition("/")
        if kind == "dir":
            entries[up][name] = (0o40000, tree_id(entries[p]), True)
        else:
            mode, h = exported(data[blob], props) if data else (0o100644, blob)
            entries[up][name] = (mode, h, False)
    return tree_id(entries[""])


# ------------------------------------------------------------------- externals

def parse_line(line, base, dir_):
    """A definition of a plain form: (path, url, revision, peg, relative, legacy), None if unusable."""
    rev = url = path = None
    relative = False
    for w in line.split():
        if w.startswith("-r"):
            if not w[2:].isdigit():
                return None
            rev = int(w[2:])
        elif w.startswith("../"):
            parts = [x for x in f"{base[len('file:///'):]}/{dir_}".split("/") if x]
            for x in w.split("/"):
                parts = parts[:-1] if x == ".." else [*parts, x]
            url = "file:///" + "/".join(parts)
            relative = not url.startswith(base)
        elif "//" in w:
            url = w
        else:
            path = w
    if not url or not path:
        return None
    head, _, tail = url.rpartition("@")
    peg = int(tail) if head and tail.isdigit() else None
    url = head if peg is not None else url
    return path, url, rev, peg, relative, line.startswith(path) and line.endswith(url)


def replay_externals(logs, dates):
    """logs {origin: (changes, property events)}, dates {origin: {rev: date}};
    origins live at file:///repos/<origin>.  Replays every host revision by
    revision.  Returns {origin: {rev: {path: (kind, id)}}} with externals applied."""
    states = {o: replay_log(*own) for o, own in logs.items()}

    def node_at(o, path, rev):
        return ["dir", None, {}, ("", 0, None)] if path == "" else states[o].get(rev, {}).get(path)

    def trace(o, path, peg, rev):
        last = max(states[o])
        if peg > last or rev > last:
            return None
        while True:
            node = node_at(o, path, peg)
            if node is None:
                return None
            _, birth, source = node[3]
            if rev >= birth:
                there = node_at(o, path, rev)
                return path if there is not None and there[3] == node[3] else None
            if source is None:
                return None
            path, peg = source

    def export(host, d, at):
        path, url, rev, peg, _, legacy = d
        known = [o for o in logs if url == f"file:///repos/{o}" or url.startswith(f"file:///repos/{o}/")]
        if not known:
            return None
        o = known[0]
        sub = url[len(f"file:///repos/{o}"):].strip("/")
        if peg is None and legacy:
            peg = rev
        if peg is None:
            peg = max((r for r, t in dates[o].items() if t <= dates[host][at]), default=None)
        if peg is None:
            return None
        rev = peg if rev is None else rev
        top = trace(o, sub, peg, rev)
        if top is None:
            return None
        rows = {"": ("dir", None)}
        for p, (k, b, _, _) in states[o][rev].items():
            if p != "" and (top == "" or p == top or p.startswith(top + "/")):
                rows["/" + p if top == "" else p[len(top):]] = (k, b)
        return rows

    out = {}
    for host in logs:
        cache, dead, current, listing = {}, set(), {}, {}
        base = f"file:///repos/{host}"
        for rev in range(1, max(states[host]) + 1):
            state, now = states[host][rev], {}
            changed = {}
            for p, n in state.items():
                value = n[2].get("svn:externals")
                if value is None or n[0] != "dir":
                    continue
                old = current.get(p)
                if old and old["life"] == n[3] and old["value"] == value:
                    now[p] = old
                    continue
                lines = [(i, x.strip(" \t\r")) for i, x in enumerate(value.split("\n"), 1)]
                defs = [(i, x, parse_line(x, base, p)) for i, x in lines if x and not x.startswith("#")]
                defs = [] if any(d is None for _, _, d in defs) else [(i, d) for i, _, d in defs]
                before = old["defs"] if old and old["life"] == n[3] else []
                now[p] = {"life": n[3], "value": value, "defs": defs, "got": {}}
                changed[p] = (before, old["got"] if before else {})
            recursive = lambda p, d: f"{base}/{p}/{d[0]}".replace(f"{base}//", f"{base}/").startswith(d[1] + "/")  # noqa: B023, E731
            again = {}
            for p, (before, _) in changed.items():
                ids = {d[:4] for _, d in now[p]["defs"]}
                for gone in {d[0] for _, d in before if d[:4] not in ids}:
                    first = next((d for _, d in now[p]["defs"] if d[0] == gone), None)
                    if first and not recursive(p, first):
                        again[p, first] = True
                        if first not in dead:
                            cache[first] = export(host, first, rev)
                            if cache[first] is None:
                                dead.add(first)
            for p, (before, got) in changed.items():
                for _, d in now[p]["defs"]:
                    if recursive(p, d):
                        continue
                    if d in got and (p, d) not in again:
                        now[p]["got"][d] = got[d]
                        continue
                    if d not in cache and d not in dead:
                        cache[d] = export(host, d, rev)
                        if cache[d] is None:
                            dead.add(d)
                    now[p]["got"][d] = None if d in dead else cache[d]
            current = now
            off = any(recursive(p, d) for p, x in now.items() for _, d in x["defs"])
            cand = {p: [((1,), n[0], n[1])] for p, n in state.items() if p != ""}
            for p, x in now.items() if not off else []:
                for no, d in x["defs"]:
                    dest = f"{p}/{d[0]}".lstrip("/")
                    parts = dest.split("/")
                    for i in range(1, len(parts)):
                        cand.setdefault("/".join(parts[:i]), []).append(((2,), "dir", None))
                    for rel, (k, b) in (x["got"][d] or {}).items():
                        cand.setdefault(dest + rel, []).append(((0, -len(p), -no), k, b))
            won = {p: min(c, key=lambda x: x[0])[1:] for p, c in cand.items()}
            files = {p for p, (k, _) in won.items() if k == "file"}
            listing[rev] = {p: v for p, v in won.items() if not any("/".join(p.split("/")[:i]) in files for i in range(1, p.count("/") + 1))}
        out[host] = listing
    return out
