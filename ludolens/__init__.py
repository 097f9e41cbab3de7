"""Analytics over a catalogue of games, as Spark jobs."""
