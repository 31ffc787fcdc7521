"""wardwatch: vitals telemetry analytics as Spark DataFrame operators.

functions/  rules and schemas (Column builders)     sources/    lens, lake access
operators/  layer transforms, reports, risk, ML,    plans/      layer stack, named queries,
            monitoring, replay, quality                         SQL oracle texts
streaming/  the four append-mode layer queries
"""
