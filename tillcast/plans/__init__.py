"""The models, layer by layer, and the refresh that builds and publishes them."""
