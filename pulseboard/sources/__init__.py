"""Record landing: raw payload frames in, typed bronze frames out, plus sinks."""
