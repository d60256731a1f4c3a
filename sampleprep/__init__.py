"""DataFrame building blocks for preparing multimodal conversation data."""
