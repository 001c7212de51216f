"""Plain-Python restatements for small inputs: one packet after the other, no Spark."""

from __future__ import annotations

from dataclasses import dataclass, field


def packet(seq, ts_us, src="10.0.0.1", dst="10.0.0.2", sport=1000, dport=80, protocol="TCP", **more):
    row = dict(
        session_id="S",
        capture_id="C",
        seq=seq,
        ts_us=ts_us,
        src_ip=src,
        dst_ip=dst,
        src_port=sport,
        dst_port=dport,
        protocol=protocol,
        packet_length=60,
        syn=0,
        ack=0,
        rst=0,
        fin=0,
        psh=0,
        icmp_type=-1,
    )
    return {**row, **more}


@dataclass
class Open:
    first: dict
    packets: list = field(default_factory=list)

    @property
    def start(self):
        return self.first["ts_us"]

    @property
    def last(self):
        return self.packets[-1]["ts_us"]

    def timeout(self):
        protocol = self.first["protocol"]
        if protocol == "TCP":
            noisy = any(p["psh"] or p["fin"] or p["rst"] for p in self.packets)
            return 30_000_000 if noisy or len(self.packets) > 3 else 3_000_000
        return 5_000_000 if protocol == "ICMP" else 15_000_000


def simulate(packets):
    """Flows in the order they are finalised: lists of packet seqs per capture."""
    finished = []
    for capture in sorted({p["capture_id"] for p in packets}):
        rows = [p for p in packets if p["capture_id"] == capture]
        live: dict = {}
        closed = []
        for p in sorted(rows, key=lambda r: (r["ts_us"], r["seq"])):
            now = p["ts_us"]
            for key in list(live):
                flow = live[key]
                if now - flow.last > flow.timeout() or now - flow.start > 60_000_000:
                    closed.append(live.pop(key))
            ends = sorted([(p["src_ip"], p["src_port"]), (p["dst_ip"], p["dst_port"])])
            key = (p["session_id"], p["protocol"], *ends)
            flow = live.setdefault(key, Open(p))
            flow.packets.append(p)
            stops = p["protocol"] == "TCP" and (p["fin"] or p["rst"])
            if stops or now - flow.start >= 60_000_000:
                closed.append(live.pop(key))
        closed.extend(live.values())
        finished.append((capture, [[q["seq"] for q in f.packets] for f in closed]))
    return finished


def windows(flows):
    """Window features by looking back over the source's flows, one by one.

    ``flows``: dicts with source, start_us, flow_index, dst_port, dst_ip, protocol, packets.
    """
    answer = {}
    for a in flows:
        before = [
            b
            for b in flows
            if b["src_ip"] == a["src_ip"]
            and (b["start_us"], b["flow_index"]) <= (a["start_us"], a["flow_index"])
            and a["start_us"] - b["start_us"] <= 5_000_000
        ]
        close = [b for b in before if a["start_us"] - b["start_us"] <= 1_000_000]
        answer[a["flow_index"]] = (
            len(close),
            len(before),
            len({b["dst_port"] for b in before}),
            len({b["dst_ip"] for b in before}),
            sum(b["packet_count_total"] for b in close if b["protocol"] == "ICMP"),
        )
    return answer
